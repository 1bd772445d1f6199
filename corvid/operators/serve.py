"""Request/response shaping around the scorer.

The API semantics: a single request carries ``text``; a batch request carries
``texts`` and gets one prediction per text, in order; an empty list gives an
empty list. Here requests are rows, so one Spark job serves any number of them,
and every request gets an answer: one that cannot be read, or has no text, gets
an error with the reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.operators.score import score_texts
from corvid.session import stored

SEAT = "_seat"
REQUEST_SCHEMA = "text string"
BATCH_REQUEST_SCHEMA = "texts array<string>"
PREDICTION = "struct<text:string,label:string,score:double,error:string>"
BAD_JSON, NO_TEXT = "invalid JSON", "text is missing"
_BAD = "_bad_json"


def parse_requests(df: DataFrame, json_col: str, schema: str = REQUEST_SCHEMA) -> DataFrame:
    """Typed request columns from a JSON body column, and ``error``: NULL, or
    why the request cannot be served. No row is dropped."""
    parsed = F.from_json(F.col(json_col), f"{schema}, {_BAD} string",
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})
    others = [c for c in df.columns if c != json_col]
    fields = [f.split()[0] for f in schema.split(", ")]
    unread = F.col(json_col).isNull() | F.col("_req").isNull() | F.col(f"_req.{_BAD}").isNotNull()
    out = df.withColumn("_req", parsed)
    return out.select(*others, *[F.col(f"_req.{f}").alias(f) for f in fields],
                      F.when(unread, F.lit(BAD_JSON)).when(F.col(f"_req.{fields[0]}").isNull(), F.lit(NO_TEXT))
                      .alias("error"))


def numbered(requests: DataFrame) -> DataFrame:
    """Requests with a number each (``SEAT``), stored: two requests may share an
    id, and both readers of the table must see the same numbers."""
    return stored(requests.withColumn(SEAT, F.monotonically_increasing_id()), "requests")


def score_singles(requests: DataFrame, weights: DataFrame, id_col: str) -> DataFrame:
    """``(id, text, label, score, error)`` of every request, one answer each; those
    without an error are scored, and only ``(label, score)`` is joined back."""
    reqs = numbered(requests)
    scored = score_texts(reqs.filter(F.col("error").isNull()), weights, [SEAT])
    return reqs.join(scored.select(SEAT, "label", "score"), SEAT, "left").drop(SEAT)


def to_responses(df: DataFrame, id_col: str) -> DataFrame:
    """P5: ``text, label, score`` -> one JSON response per row, or its error."""
    good = F.to_json(F.struct("text", "label", "score"))
    return df.select(id_col, F.when(F.col("error").isNull(), good)
                     .otherwise(F.to_json(F.struct("error"))).alias("response"))


def score_requests(requests: DataFrame, weights: DataFrame, id_col: str,
                   texts_col: str = "texts") -> DataFrame:
    """``(id, texts)`` -> ``(id, predictions)``, order kept, empty stays empty.

    Texts are exploded with their position and scored as rows; only the small
    ``(pos, label, score)`` triples are grouped per request (a request is the
    bound: its own ``texts`` are one row already), then looked up by position
    (J1). A NULL text keeps its place, with an error instead of a label. Requests
    that share an id are answered one by one.
    """
    reqs = numbered(requests)
    items = (reqs.select(SEAT, F.posexplode_outer(texts_col).alias("pos", "text"))
             .filter(F.col("pos").isNotNull() & F.col("text").isNotNull()))
    scored = score_texts(items, weights, [SEAT, "pos"])
    per_req = scored.groupBy(SEAT).agg(F.map_from_entries(F.collect_list(
        F.struct("pos", F.struct("label", "score")))).alias("_p"))
    joined = reqs.join(per_req, SEAT, "left")
    preds = F.transform(F.col(texts_col), lambda t, i: F.struct(
        t.alias("text"), F.col("_p")[i]["label"].alias("label"), F.col("_p")[i]["score"].alias("score"),
        F.when(t.isNull(), F.lit(NO_TEXT)).alias("error")))
    return joined.select(id_col, F.coalesce(preds, F.array().cast(f"array<{PREDICTION}>"))
                         .alias("predictions"))
