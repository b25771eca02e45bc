"""Streaming: intentionally empty.

The analytics this library rebuilds are batch only -- no watermarks, windows
over event time, stateful operators or late data exist in them -- so there is
no Structured Streaming code here.  The batch concepts read their inputs with
``spark.read`` and can be re-run on new data; a streaming variant would be a
different product, not a rebuild.
"""
