"""New articles are extracted as they arrive; the stream's checkpoint stands for the flag `extracted`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillweave import schemas as S
from quillweave.operators.store import Store
from quillweave.plans.extract import Classifier, Tagger, extract


def into_store(store: Store, tagger: Tagger, classifier: Classifier, lexicon: DataFrame, refresh: bool = False) -> Callable[[DataFrame, int], None]:
    """What a micro-batch does: upsert its articles, extract, replace their rows. Done twice it gives the same tables, so a
    batch that is repeated after a failure does no harm. Only the buckets that the articles fall into are rewritten; `refresh` brings the graph up
    to date with each batch."""

    def batch(articles: DataFrame, _: int) -> None:
        rest = [c for c in articles.columns if c != "pmid"]
        articles = articles.where(F.col("pmid").isNotNull()).groupBy("pmid").agg(F.max(F.struct(*rest)).alias("row")).select("pmid", "row.*").persist()
        try:
            store.upsert(articles)
            store.extract(lambda keep: extract(articles, tagger, classifier, lexicon, keep=keep))
            if refresh:
                store.refresh_graph()
        finally:
            articles.unpersist()

    return batch


def stream(spark: SparkSession, folder: str, store: Store, checkpoint: str, tagger: Tagger, classifier: Classifier, lexicon: DataFrame, once: bool = True, refresh: bool = False) -> StreamingQuery:
    """Articles as JSON lines that appear in a folder. `once` takes all there is and ends."""
    source = spark.readStream.schema(S.ARTICLES + ", query_label string").json(folder)
    writer = source.writeStream.foreachBatch(into_store(store, tagger, classifier, lexicon, refresh)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
