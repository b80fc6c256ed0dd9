"""labwire: a Spark-native engine for HL7 v2.5 lab-order messages.

Every transform is a ``Column -> Column`` or ``DataFrame -> DataFrame``
function built from Spark's own expressions, so the same code serves batch
tables and Structured Streaming micro-batches.
"""

__version__ = "0.1.0"
