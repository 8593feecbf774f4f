"""Operators: plain functions from DataFrame to DataFrame.

Each one can be chained with ``df.transform`` and takes its thresholds, windows
and reference instants as arguments. Unless its text says otherwise it accepts
static and streaming input.
"""
