"""PII (8): information-theoretic sanitisation.

Protected entities (e-mail, ip, card, phone) are found by pattern. The corpus
then tells which terms give an entity away; every word, a run of letters, marks and
digits of any length, is a candidate. For an entity ``e`` and a term ``t``
within ``REACH`` characters of it, document counts estimate

    PMI(t, e) = log2( n(t, e) * N / (n(t) * n(e)) ),   IC(e) = log2( N / n(e) )

and ``PMI / IC`` is the share of the entity's information that the term
discloses: 1 when the term occurs only where the entity does. Terms of a share
of ``DISCLOSURE`` or more, seen with the entity in ``SUPPORT`` or more documents
(copies count), are spans of kind ``term`` at all their places in all texts, outside
entities. ``sanitise`` replaces entities by their kind,
removes terms that disclose all (``REMOVE`` and more) and generalises the rest
to the kind of word they are. Counts cover all texts.

Only DataFrame functions. Entity-term pairs are counted per text before they
are counted per pair, words per task before they move, so neither an entity nor
a word of every third text gathers in one task.

Defined cases: null texts are empty and have no spans; equal texts get equal
spans; an empty table gives no rows; extra columns are kept by ``sanitise`` and
ignored by ``personal_spans``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.llm.secrets import count_kind
from corvid.llm.spans import (FEW, PLACES, SPANS, block_text, blocks_of, cells_of, joined, let,
                              match_parts, matches, meets, placed, replaced)
from corvid.llm.spark_util import read_table, stored

# fixed values: the base kinds. A match starts at the head of a run or where the
# last match ended, and repeats are possessive: the same matches, in linear time.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")

#: Joins what is told apart as one string (Spark finds equal strings by hashing,
#: equal structs by comparing all).
CUT = "\u0001"
REACH = 80
DISCLOSURE, REMOVE, SUPPORT = 0.9, 0.999, 3
CHAR = r"[\p{L}\p{M}\p{N}]"
TERM = CHAR + "++"
ADDED = "array<struct<start:long,rank:int,kind:string,end:long,share:double>>"
FOUND = "array<struct<start:long,end:long,text:string,value:string,rank:int,kind:string>>"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def _ip_ok(m: Column) -> Column:
    return F.forall(F.split(m["text"], r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))) <= 3) & F.forall(
        F.split(m["text"], r"\."), lambda p: F.coalesce(F.substring(F.ltrim(p, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) <= 255)


def _card_ok(m: Column) -> Column:
    d = _digits(m["text"])
    total = F.aggregate(F.transform(F.split(F.reverse(d), ""), lambda c, i: F.when(
        i % 2 == 0, F.coalesce(c.try_cast("int"), F.lit(0))).otherwise(
        F.get(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), F.coalesce(c.try_cast("int"), F.lit(0))))),
        F.lit(0), lambda a, b: a + b)
    return F.length(d).between(12, 19) & (total % 10 == 0)


def _phone_ok(m: Column) -> Column:
    return F.length(_digits(m["text"])).between(9, 15)


def _found(text: Column) -> list[Column]:
    return [matches(text, p).alias(k) for k, p in zip(KINDS, (EMAIL, IP, CARD, PHONE))]


CHECKS = {"ip": _ip_ok, "card": _card_ok, "phone": _phone_ok}


def _kind(kind: str, rank: int) -> Column:
    """The matches of one kind that pass its check."""
    passed = F.filter(kind, CHECKS[kind]) if kind in CHECKS else F.col(kind)
    return F.transform(passed, lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), m["text"].alias("text"),
        F.lower(m["text"]).alias("value"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind")))


def entity_rows(docs: DataFrame, text: str = "text", carry: tuple[Column, ...] = ()) -> DataFrame:
    """``node`` (md5 of the text), ``found`` entities, ``terms`` near them."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(*carry, body.alias("_text"), F.md5(body).alias("node"))
    named = [c for c in rows.columns if c != "_text"]
    rows = rows.select(*named, "_text", *_found(F.col("_text")))
    rows = rows.select(*named, "_text", F.array_sort(F.concat(
        *[_kind(k, i) for i, k in enumerate(KINDS, 1)])).cast(FOUND).alias("found"))
    return rows.select(*named, "_text", "found", F.when(F.size("found") > 0, near_terms(F.col("_text"), F.col("found")))
                       .otherwise(F.array()).cast("array<struct<kind:string,value:string,term:string,start:long,end:long>>")
                       .alias("terms"))


def near_terms(text: Column, found: Column) -> Column:
    """Terms within ``REACH`` characters of each entity, with their places.

    Texts with many entities are read block by block, and a term is compared
    with the entities of its own stretch: the time grows with the text."""
    def words(part: Column, offset: Column, m: Column) -> Column:
        return F.transform(matches(part, TERM).cast(PLACES), lambda w: F.struct(
            m["kind"].alias("kind"), m["value"].alias("value"), F.lower(w["text"]).alias("term"),
            (offset + w["start"]).alias("start"), (offset + w["end"]).alias("end")))

    def around(m: Column, b: Column) -> Column:
        # words cut by the edge of the reach or of the entity do not count
        begin = F.greatest(m["start"] - REACH, F.lit(0))
        before = block_text(b, begin, m["start"] - begin)
        cut = F.when(begin == 0, F.lit(0)).otherwise(F.length(F.regexp_extract(before, f"^{CHAR}*+", 0)))
        before = F.substring(before, (cut + 1).cast("int"), F.lit(REACH))
        before = F.when(m["text"].rlike(f"^{CHAR}"), F.regexp_replace(before, rf"(?<!{CHAR}){CHAR}++\z", "")).otherwise(before)
        after = block_text(b, m["end"], F.lit(REACH))
        after = F.when(m["end"] + REACH >= b["size"], after).otherwise(F.regexp_replace(after, rf"(?<!{CHAR}){CHAR}++\z", ""))
        skip = F.when(m["text"].rlike(rf"{CHAR}\z"), F.length(F.regexp_extract(after, f"^{CHAR}*+", 0))).otherwise(0)
        after = F.substring(after, (skip + 1).cast("int"), F.lit(REACH))
        return F.concat(let(F.struct(before.alias("t"), (begin + cut).alias("at")), lambda x: words(x["t"], x["at"], m)),
                        let(F.struct(after.alias("t"), (m["end"] + skip).alias("at")), lambda x: words(x["t"], x["at"], m)))

    def clear(b: Column) -> Column:
        return let(cells_of(found, b["size"]), lambda cells: F.filter(
            F.flatten(F.transform(found, lambda m: around(m, b))), lambda t: ~meets(t, found, cells)))
    return let(blocks_of(text, F.size(found) > FEW), clear)


def disclosing(rows: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """``(kind, value, term, share)`` of the terms that disclose an entity.

    ``rows`` are stored ``entity_rows`` of ``docs``.
    """
    n = rows.count()
    near = (rows.filter(F.size("terms") > 0)
            .select(F.explode(F.array_distinct(F.transform("terms", lambda t: F.concat_ws(
                CUT, t["kind"], t["value"], t["term"])))).alias("p"))
            .select(*[F.get(F.split("p", CUT), i).alias(c) for i, c in enumerate(("kind", "value", "term"))])
            .groupBy("kind", "value", "term").agg(F.count(F.lit(1)).alias("n_te"))
            .filter(F.col("n_te") >= SUPPORT))
    near = stored(near, "near-terms")
    entities = stored(rows.select(F.explode(F.array_distinct(F.transform("found", lambda m: F.concat_ws(
                    CUT, m["kind"], m["value"])))).alias("p"))
                      .select(F.get(F.split("p", CUT), 0).alias("kind"), F.get(F.split("p", CUT), 1).alias("value"))
                      .groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n_e")), "entity-counts")
    words = docs.select(F.explode(F.array_distinct(_words(F.coalesce(F.col(text), F.lit(""))))).alias("term"))
    # counted in each task before any shuffle, so that a frequent word is a few rows
    counts = words.groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    total = F.lit(float(max(n, 1)))
    pmi = F.log2(F.col("n_te") * total / (F.col("n_t") * F.col("n_e")))
    info = F.log2(total / F.col("n_e"))
    shares = (near.join(entities, ["kind", "value"]).join(counts, "term")
              .withColumn("share", F.when(info > 0, pmi / info).otherwise(0.0))
              .filter(F.col("share") >= DISCLOSURE).select("kind", "value", "term", "share"))
    return stored(shares, "disclosing")


def term_spans(docs: DataFrame, pairs: DataFrame, text: str = "text") -> DataFrame:
    """``(node, added)``: all places of disclosing terms, one row for each text
    that has any. A term that discloses several entities has its largest share."""
    terms = stored(pairs.groupBy("term").agg(F.max("share").alias("share")), "disclosing-terms")
    body = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(F.md5(body).alias("node"), body.alias("_text"))
    hits = stored(texts.select("node", F.explode(F.array_distinct(_words(F.col("_text")))).alias("term"))
                  .join(terms, "term").select("node", "term", "share").distinct()
                  .groupBy("node").agg(F.collect_list(F.struct("term", "share")).alias("hits")), "term-texts")
    # equal texts have equal places
    return (texts.join(hits, "node").select("node", term_places(F.col("_text"), F.col("hits")).alias("added"))
            .groupBy("node").agg(F.any_value("added").alias("added")))


def _words(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower)


def term_places(text: Column, hits: Column) -> Column:
    """The places of the words of ``text`` that are terms of ``hits``, in order."""
    def of(share: Column) -> Column:
        def one(begin: Column, end: Column, x: Column) -> Column:
            return let(F.try_element_at(share, F.lower(x["m"])), lambda found: F.when(
                found.isNull(), F.array().cast(ADDED)).otherwise(F.array(F.struct(
                    begin.alias("start"), F.lit(5).alias("rank"), F.lit("term").alias("kind"), end.alias("end"),
                    found.alias("share"))).cast(ADDED)))

        def shift(x: Column, off: Column) -> Column:
            return F.struct((x["start"] + off).alias("start"), x["rank"].alias("rank"), x["kind"].alias("kind"),
                            (x["end"] + off).alias("end"), x["share"].alias("share"))
        return placed(match_parts(text, TERM), ADDED, one, shift)
    return let(F.map_from_entries(hits), of)


def clear_of(added: Column, found: Column) -> Column:
    """The places of terms outside entities."""
    terms = F.coalesce(added, F.array().cast(ADDED))
    size = F.greatest(F.coalesce(F.array_max(F.transform(found, lambda m: m["end"])), F.lit(0)),
                      F.coalesce(F.array_max(F.transform(terms, lambda t: t["end"])), F.lit(0)))
    return let(cells_of(found, size), lambda cells: F.filter(terms, lambda t: ~meets(t, found, cells)))


def _base(found: Column) -> Column:
    return F.transform(found, lambda m: F.struct(m["start"], m["rank"], m["kind"], m["end"])).cast(SPANS)


def personal_spans(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, base, added)`` of every row of ``docs``."""
    rows = stored(entity_rows(docs, carry=(F.col(key).alias("key"),)).drop("_text"), "entities")
    added = stored(term_spans(docs, disclosing(rows, docs)), "term-spans")
    return rows.select("key", "node", "found").join(added, "node", "left").select(
        "key", _base(F.col("found")).alias("base"),
        F.transform(clear_of(F.col("added"), F.col("found")), lambda s: F.struct(
            s["start"], s["rank"], s["kind"], s["end"])).cast(SPANS).alias("added"))


def sanitise(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` with entities and disclosing terms taken out of
    ``text``; ``n_chars``, if there, counts the new text."""
    names = docs.columns
    row = F.struct(*[docs[c] for c in names]).alias("row")
    rows = stored(entity_rows(docs).drop("_text"), "entities")
    added = stored(term_spans(docs, disclosing(rows, docs)), "term-spans")
    whole = entity_rows(docs, carry=(row,)).drop("terms", "_text").join(added, "node", "left")
    kept = clear_of(F.col("added"), F.col("found"))
    body = F.col("row.text")
    # of those that start together the longest is first
    edits = F.array_sort(F.concat(
        F.transform("found", lambda m: F.struct(m["start"].alias("start"), (-m["end"]).alias("back"), m["end"].alias("end"),
                                                F.concat(F.lit("["), F.upper(m["kind"]), F.lit("]")).alias("put"))),
        F.transform(kept, lambda s: F.struct(
            s["start"].alias("start"), (-s["end"]).alias("back"), s["end"].alias("end"), F.when(s["share"] >= REMOVE, F.lit(""))
            .when(F.substring(body, (s["start"] + 1).cast("int"), F.lit(1)).rlike(r"\p{Lu}"), F.lit("[NAME]"))
            .when(F.substring(body, (s["start"] + 1).cast("int"), F.lit(1)).rlike(r"\p{N}"), F.lit("[NUMBER]"))
            .otherwise(F.lit("[WORD]")).alias("put")))))
    # a text without edits stays as it is, null too
    changed = whole.withColumn("_edits", edits).withColumn("_new", F.when(
        F.size("_edits") > 0, replaced(body, F.col("_edits"))).otherwise(body))
    values = [F.col("_new").alias(c) if c == "text"
              else F.when(F.size("_edits") > 0, F.length("_new").cast("long")).otherwise(F.col(f"row.`{c}`")).alias(c) if c == "n_chars"
              else F.col(f"row.`{c}`") for c in names]
    return changed.select(*values)


def op8_pii(spark, sf_dir: str) -> DataFrame:
    rows = personal_spans(read_table(spark, sf_dir, "documents"))
    base = F.col("base")
    return rows.select(
        F.col("key").alias("doc_id"), *[count_kind(base, k).alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.concat("base", "added")).alias("spans"))
