"""Index one text of 200 MB with a heap of one gigabyte; prints the statistics."""

import sys
import tempfile
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from wordloom import IndexSession

folder = tempfile.mkdtemp(prefix="long-text-")
words = [f"w{n:03d}" for n in range(10)]
text = (" ".join(words) + " ") * 4_000_000 + "end " * 11 + "z" * 1_000_000
pq.write_table(pa.table({"path": ["long.txt"], "text": [text]}), f"{folder}/texts.parquet")
del text
spark = (
    SparkSession.builder.master("local[2]")
    .config("spark.driver.memory", "1g")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "2")
    .config("spark.checkpoint.dir", folder)
    .getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")
session = IndexSession(spark)
print(*session.index_table(spark.read.parquet(f"{folder}/texts.parquet")).first())
spark.stop()
