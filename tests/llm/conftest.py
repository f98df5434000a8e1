import pytest
from pyspark.sql import SparkSession

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", "file://" + str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )


@pytest.fixture
def documents(spark):
    def make(rows, schema=DOCUMENTS):
        """rows: texts, or whole rows."""
        whole = [x if isinstance(x, tuple) else (k, x, "en", "src0", len(x or "")) for k, x in enumerate(rows)]
        return spark.createDataFrame(whole, schema)

    return make
