"""reviewlake: shop-review analytics as Spark DataFrame / SQL / MLlib / Structured Streaming operators.

Every operator is a function ``DataFrame -> DataFrame`` (or ``Column -> Column`` for scalar rules)
so that Catalyst sees one declarative plan per query.
"""

__version__ = "0.1.0"
