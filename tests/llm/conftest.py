import pytest


@pytest.fixture()
def docs_of(spark):
    """docs_of([(doc_id, text), ...], extra columns) -> DataFrame with clashing extra names."""
    def make(rows, partitions=2):
        data = [(i, t, "x", 0) for i, t in rows]
        df = spark.createDataFrame(data, "doc_id long, text string, keep_id string, n long")
        return df.repartition(partitions) if partitions else df
    return make
