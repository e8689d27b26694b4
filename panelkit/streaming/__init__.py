"""Streaming: intentionally empty.

The reference pipeline is batch only - no streams, watermarks, windows over
event time or stateful operators - so there is nothing to re-express with
Structured Streaming.  Every operator in ``panelkit.operators`` is a plain
DataFrame transformation and can be applied to a micro-batch inside a
``foreachBatch`` sink by the caller if ever needed.
"""
