"""The user-function surfaces, checked against the SQL of the same results."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from corvid.functions.probs import LABEL_MAP
from corvid.functions.text import CLS, MODEL_MARK, UNK, WORD_SPLIT
from corvid.operators.score import score_texts
from corvid.operators.udfs import broadcast_table, grouped_metric, map_batched
from corvid.plans import ORACLE, register
from corvid.plans.common import labelled, model
from corvid.sources.tables import load_table

def _tokens(texts: pd.Series, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """Non-empty pieces between the matches of ``pattern`` in the lower-cased
    texts, flat, and how many each text has; Arrow works on the whole batch."""
    split = pc.split_pattern_regex(pc.utf8_lower(pa.array(texts.fillna(""), pa.string())), pattern)
    flat, row = split.flatten(), pc.list_parent_indices(split).to_numpy()
    full = pc.not_equal(flat, "")
    return flat.filter(full), np.bincount(row[full.to_numpy(zero_copy_only=False)], minlength=len(texts))


#: Characters of text that are tokenized at once; a longer text is a part of its own.
PART_CHARS = 1 << 20


def _parts(texts: pd.Series, limit: int = PART_CHARS) -> Iterator[pd.Series]:
    """``texts`` in parts of whole texts: the token columns of a part, not those
    of the whole batch, are in memory at once."""
    ends = np.concatenate([[0], np.cumsum(texts.str.len().fillna(0).to_numpy(), dtype=np.int64)])
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + limit, "right")) - 1)
        yield texts.iloc[lo:hi]
        lo = hi


def _tokenize_batch(pdf: pd.DataFrame) -> pd.DataFrame:
    counts, digests = [], []
    for texts in _parts(pdf["text"]):
        flat, n = _tokens(texts, WORD_SPLIT)
        ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), flat), " ")
        counts += n.tolist()
        digests += [hashlib.md5(t.encode()).hexdigest() for t in joined.to_pylist()]
    return pd.DataFrame({"doc_id": pdf["doc_id"], "n_tokens": np.array(counts, "int64"), "tokens_md5": digests})


@register("udf_map_batched")
def q_udf_map_batched(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    return map_batched(docs, _tokenize_batch, "doc_id bigint, n_tokens bigint, tokens_md5 string")


def _f1_partial(pdf: pd.DataFrame) -> pd.DataFrame:
    y, p = pdf["truth"], pdf["pred"]
    df = pd.DataFrame({"split": pdf["split"],
                       "tp": ((y == 1) & (p == 1)).astype("int64"),
                       "fp": ((y == 0) & (p == 1)).astype("int64"),
                       "fn": ((y == 1) & (p == 0)).astype("int64"),
                       "tn": ((y == 0) & (p == 0)).astype("int64")})
    return df.groupby("split", as_index=False).sum()


def _f1_final(pdf: pd.DataFrame) -> pd.DataFrame:
    tp, fp, fn, tn = (float(pdf[c].iloc[0]) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn

    def f1(a, b, c):
        d = 2 * a + b + c
        return 0.0 if d == 0 else 2 * a / d
    return pd.DataFrame({"split": [pdf["split"].iloc[0]], "n": [int(n)],
                         "accuracy": [(tp + tn) / n], "f1": [f1(tp, fp, fn)],
                         "f1_neg": [f1(tn, fn, fp)]})


@register("udaf_metrics")
def q_udaf_metrics(spark, sf_dir):
    from corvid.plans.score_plans import scored_labelled
    s = scored_labelled(spark, sf_dir).select("split", "truth", "pred")
    out = grouped_metric(s, ["split"], _f1_partial, "tp bigint, fp bigint, fn bigint, tn bigint",
                         _f1_final, "split string, n bigint, accuracy double, f1 double, f1_neg double")
    return out.select("split", "n", *[F.round(c, 6).alias(c) for c in ("accuracy", "f1", "f1_neg")])


def model_udf(spark, weights):
    """An iterator pandas UDF scoring text with a weight table loaded once.

    The texts of a batch become one flat token column; each distinct token is
    looked up once, and the weights are added up per text by numpy."""
    bc = broadcast_table(spark, weights, "token", ["w0", "w1"])

    @F.pandas_udf("struct<pred:int,prob:double>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = bc.value  # set up once per task, before the loop
        cls, unk = table[CLS], table[UNK]

        def scored(texts: pd.Series) -> pd.DataFrame:
            spaced = pc.replace_substring_regex(pa.array(texts.fillna(""), pa.string()), MODEL_MARK, r" \0 ")
            flat, n = _tokens(spaced.to_pandas(), "[ \t\n\r\f]+")
            coded = flat.dictionary_encode()
            w = np.array([table.get(t, unk) for t in coded.dictionary.to_pylist()]).reshape(-1, 2)
            at = w[coded.indices.to_numpy()]
            row = np.repeat(np.arange(len(n)), n)
            l0, l1 = (cls[c] + np.bincount(row, at[:, c], minlength=len(n)) for c in (0, 1))
            m = np.maximum(l0, l1)
            e0, e1 = np.exp(l0 - m), np.exp(l1 - m)
            p0, p1 = e0 / (e0 + e1), e1 / (e0 + e1)
            return pd.DataFrame({"pred": (p1 > p0).astype("int32"), "prob": np.maximum(p0, p1)})

        none = pd.DataFrame({"pred": np.empty(0, "int32"), "prob": np.empty(0)})
        for texts in batches:
            yield pd.concat([none, *map(scored, _parts(texts))], ignore_index=True)
    return score


@register("udf_model")
def q_udf_model(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents")
    f = model_udf(spark, model(spark, sf_dir))
    s = docs.select("doc_id", f(F.col("text")).alias("r"))
    names = F.create_map(*[F.lit(x) for kv in LABEL_MAP.items() for x in kv])
    return s.select("doc_id", F.col("r.pred").alias("pred"),
                    F.element_at(names, F.concat(F.lit("LABEL_"), F.col("r.pred").cast("string")))
                    .alias("label"),
                    F.round("r.prob", 4).alias("score"))


def _attach_oracles():
    from corvid.plans import score_plans, text_plans  # noqa: F401
    ORACLE["udf_map_batched"] = ORACLE["tokenize_words"]
    ORACLE["udaf_metrics"] = ORACLE["eval_binary"]
    ORACLE["udf_model"] = ORACLE["score_texts"]


_attach_oracles()
