"""The collection loop as Structured Streaming jobs.

All sinks are written per micro-batch, under the micro-batch's number, so a replayed micro-batch
replaces its own output and nothing else.
"""
