"""Running streams: triggers, checkpoints, several sinks per micro-batch."""
