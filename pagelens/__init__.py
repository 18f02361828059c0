"""pagelens: Spark-native web-content and SEO analytics.

Every operator is a DataFrame -> DataFrame function (``pagelens.operators``)
or a Column -> Column function (``pagelens.functions``) built from Spark SQL
expressions. Loaders and derived input views live in ``pagelens.sources``;
the registered query catalogue (Spark plan + DuckDB oracle text) lives in
``pagelens.plans``; Structured Streaming jobs live in ``pagelens.streaming``.
"""

from pagelens.session import get_spark, checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
