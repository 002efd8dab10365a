"""The figures that the README states: ``python -m paperloom.llm.figures /path/to/tables``."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from paperloom.llm.increments import ShardedIndex, encode
from paperloom.llm.queries import QUERIES
from paperloom.llm.reading import Levels
from paperloom.session import table, wide


def main(folder: str) -> None:
    spark = SparkSession.builder.appName("figures").getOrCreate()
    docs = wide(spark, folder, "documents", "doc_id", "text", "lang")
    print("problem 10, labelled texts with their own n-grams taken out (0: Korean, 1: English)")
    Levels(docs, table(spark, folder, "reading_labels")).held_out().show()
    print("problem 8, containers and the least number that any packing needs")
    QUERIES["p8_usage"](spark, folder).orderBy("spec_id").show()
    print("problem 7, recall of each shard against exhaustive search on retyped members")
    index = ShardedIndex(spark)
    index.add(encode(wide(spark, folder, "kci_corpus")))
    index.recall().show()
    print("problem 9, shares reached")
    QUERIES["p9_shares"](spark, folder).orderBy("mix_id", "source").show(100)


if __name__ == "__main__":
    main(sys.argv[1])
