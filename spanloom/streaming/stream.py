"""The same stages over streams of reports."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from spanloom.functions.text import tokens
from spanloom.operators.fields import quarantine
from spanloom.operators.rules import Rule, annotate
from spanloom.operators.substitute import Policy
from spanloom.plans.deidentify import deidentify_reports
from spanloom.plans.stages import Settings


def read_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def annotate_stream(docs: DataFrame, phases: dict[str, list[Rule]]) -> DataFrame:
    """Annotations of a stream of documents: no state, since no rule looks beyond its document."""
    return annotate(docs, phases)


def write_stream(df: DataFrame, path: str, checkpoint: str, sink: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Append to Parquet, or hand each batch to ``sink``; ends when all that is there is done."""
    writer = df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return writer.foreachBatch(sink).start() if sink else writer.format("parquet").option("path", path).start()


def windowed_counts(events: DataFrame, time_col: str = "ts", width: str = "1 hour", late: str = "10 minutes", by: str = "event_type") -> DataFrame:
    """Events by tumbling window and kind; later than the watermark they are left out."""
    return events.withWatermark(time_col, late).groupBy(F.window(time_col, width).alias("w"), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), by, "n")


def deidentify_stream(reports: DataFrame, policy: Policy, settings: Settings, path: str, checkpoint: str, plan: list[str] | None = None, xml: bool = False) -> StreamingQuery:
    """A stream of ``reports(doc_id, content)`` through the whole chain, batch by batch, with the site's tables as they are.

    Results go to ``path/reports/batch=<n>``, reports that can't be read to
    ``path/quarantine/batch=<n>``. A batch that is run again after a failure writes
    over its own folders, so a restart from the checkpoint leaves no row twice and
    none out.
    """

    def write(batch: DataFrame, number: int) -> None:
        put = lambda df, kind: df.write.mode("overwrite").parquet(f"{path}/{kind}/batch={number}")
        put(quarantine(batch, xml=xml), "quarantine")
        put(deidentify_reports(batch, policy, settings, xml=xml, plan=plan), "reports")

    return write_stream(reports, path, checkpoint, write)


#: What ends a sentence, as in the batch operator: marks, and newlines.
STOPS = r"[.!?]|\r?\n"


def numbered_pieces(pieces: DataFrame, text_col: str = "text") -> DataFrame:
    """A stream of ``(doc_id, piece, text)`` with ``first_sentence`` and ``n_sentences``: numbers that go on through a document's pieces.

    Documents arrive in pieces, over many batches; of each only the next number is
    kept as state. Pieces of one document that come in one batch are taken by their
    number; a piece that comes again gets numbers of its own.
    """
    counted = pieces.select("doc_id", "piece", F.size(F.filter(tokens(text_col), lambda t: t.rlike(f"^(?:{STOPS})$"))).alias("n_sentences"))

    def number(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values("piece", kind="stable")
        before = state.get[0] if state.exists else 0
        rows["first_sentence"] = before + rows["n_sentences"].cumsum() - rows["n_sentences"]
        state.update((int(before + rows["n_sentences"].sum()),))
        yield rows[["doc_id", "piece", "first_sentence", "n_sentences"]]

    return counted.groupBy("doc_id").applyInPandasWithState(number, "doc_id long, piece long, first_sentence long, n_sentences long", "next long", "append", GroupStateTimeout.NoTimeout)
