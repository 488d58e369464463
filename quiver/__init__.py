"""quiver: Spark-native operators for recommender, text, annotation and experiment data.

Every operator is a plain function ``DataFrame -> DataFrame`` built from the
DataFrame API, so Catalyst sees one logical plan end to end.
"""

__version__ = "0.1.0"
