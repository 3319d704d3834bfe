import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from quarterlens.session import DEFAULT_CONF, ensure_checkpoint_dir

    b = SparkSession.builder.master("local[4]").appName("quarterlens-tests") \
        .config("spark.sql.shuffle.partitions", "8")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s, str(tmp_path_factory.mktemp("ckpt")))
    yield s


def rows(df, *cols):
    """Collect selected columns as plain tuples (small test outputs only)."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
