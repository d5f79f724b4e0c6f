"""Small report documents with results worked out by hand."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilspark.functions.semistructured import parse

SEEDED = [("DrugA", "ReactionX", 60), ("DrugA", "Nausea", 20),
          ("DrugB", "ReactionX", 5), ("DrugB", "Nausea", 100)]
BACKGROUND = [(d, r, 12) for d in ("Aspirin", "Ibuprofen", "Paracetamol", "Stat-10", "Z-Pack")
              for r in ("Headache", "Dizziness", "Rash", "Fatigue", "Insomnia")]


def doc(id_, drugs=(), reactions=(), **report) -> dict:
    """One report; drugs and reactions are names or whole elements."""
    patient = {
        "age": [{"value": 45}], "sex": 1,
        "drug": [{"medicinalproduct": d} if isinstance(d, str) else d for d in drugs],
        "reaction": [{"reactionmeddrapt": r} if isinstance(r, str) else r for r in reactions],
    }
    patient.update(report.pop("patient", {}))
    return {"safetyreport": [{"id": id_, "receivedate": "20240105", "patient": [patient], **report}]}


def seeded_docs() -> list[dict]:
    return [doc(f"REP-{d}-{r}-{i}", [d], [r]) for d, r, n in SEEDED + BACKGROUND for i in range(n)]


def raw(spark: SparkSession, docs: list, loaded: str = "2024-02-01 00:00:00", first_id: int = 1) -> DataFrame:
    """Raw table of documents (dicts, texts, or ``(document, load time)`` pairs)."""
    rows = []
    for n, item in enumerate(docs):
        body, at = item if isinstance(item, tuple) else (item, loaded)
        rows.append((first_id + n, f"f{first_id + n}.json",
                     body if isinstance(body, str) else json.dumps(body), at))
    frame = spark.createDataFrame(rows, "file_id long, file_name string, content string, at string")
    return frame.select(
        "file_id", "file_name", F.col("at").cast("timestamp").alias("ingestion_timestamp"),
        parse("content").alias("raw_json"), F.lit("PROCESSED").alias("file_status"))


def rows(df: DataFrame, *cols: str) -> list[tuple]:
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()),
                  key=lambda t: [(v is not None, str(v)) for v in t])
