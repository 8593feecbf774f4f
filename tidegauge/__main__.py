import sys

from tidegauge.plans.jobs import main

sys.exit(main())
