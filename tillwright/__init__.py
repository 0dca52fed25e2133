"""tillwright: a Spark-native point-of-sale analytics engine.

Sales events arrive as keyed JSON messages, land in a raw (bronze) layer,
are cleaned into a typed (silver) layer and aggregated into business (gold)
tables. Every operator is a plain ``DataFrame -> DataFrame`` function built
from DataFrame / Spark SQL / Structured Streaming primitives, so the same
code serves batch and streaming input.
"""

__version__ = "0.1.0"
