"""Secrets in texts, told apart by who owns them. Built-in functions only.

Three known shapes are found by pattern: assignments, access keys and long hexadecimal runs.
Further candidates are long tokens that mix letters and digits. The hash of every candidate is
then counted over the whole corpus: one that several owners have is a copied example, one that
belongs to a single owner looks live. A token is added to the found spans if it looks live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.frames import cut


def either_case(text: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in text)


_NAMES = "|".join(either_case(x) for x in ("password", "passwd", "secret", "token", "api_?key"))
#: Kind, pattern, group that holds the value. The order breaks ties between spans.
ASSIGN = rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
TOKEN = "[A-Za-z0-9+/_-]{20,}"
#: Fewest characters of an assigned value.
VALUE_LENGTH = 6
MARK = "<SECRET>"
SPAN = "struct<start:bigint,order:int,end:bigint,kind:string,hash:string>"


def _starts(text: Column, pattern: str, matches: Column, values: Column, order: int, kind: str) -> Column:
    """Spans of all matches. What stands between them adds up to where they begin."""
    between = F.slice(F.split(text, pattern, -1), 1, F.size(matches))
    parts = F.arrays_zip(between.alias("gap"), matches.alias("match"), values.alias("value"))
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["match"])
        span = F.struct(
            start.alias("start"), F.lit(order).alias("order"), end.alias("end"), F.lit(kind).alias("kind"),
            F.when(F.length(x["value"]) > 0, F.sha2(x["value"], 256)).alias("hash"),
        )
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    found = F.aggregate(parts, begin, add)["spans"]
    return F.when(F.size(matches) > 0, found).otherwise(F.array().cast(f"array<{SPAN}>"))


def candidates(docs: DataFrame, owner: str = "source") -> DataFrame:
    """(doc_id, text_hash, owner, base, tokens): spans of the three shapes and of tokens."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"), text.alias("text")
    )
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "token": TOKEN}
    matched = read.select("*", *[F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(k) for k, p in patterns.items()])
    # A value that is too short becomes empty here, and its span has no hash.
    values = F.when(F.size("assign") > 0, F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2))).otherwise(F.array().cast("array<string>"))
    matched = matched.withColumn("value", F.transform(values, lambda v: F.when(F.length(v) >= VALUE_LENGTH, v).otherwise(F.lit(""))))
    spans = matched.select(
        "doc_id", "owner", F.xxhash64("text").alias("text_hash"),
        *[
            _starts(F.col("text"), p, F.col(k), F.col("value" if k == "assign" else k), order, k).alias(k)
            for order, (k, p) in enumerate(patterns.items())
        ],
        F.col("token").alias("words"),
    )
    base = F.array_sort(F.filter(F.concat("assign", "access", "hex"), lambda s: s["hash"].isNotNull()))
    mixed = F.zip_with("token", "words", lambda s, w: F.when(w.rlike("[0-9]") & w.rlike("[A-Za-z]"), s))
    tokens = F.filter(mixed, lambda s: s.isNotNull())
    spans = spans.select("doc_id", "text_hash", "owner", base.alias("base"), tokens.alias("tokens"))
    free = F.filter("tokens", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    return spans.withColumn("tokens", free)


def ownership(found: DataFrame) -> DataFrame:
    """(hash, n_owners, n_documents) of every candidate, over the whole corpus.

    Rows are made distinct and counted step by step, each pre-aggregated by the tasks that
    have them, so a hash that a third of the documents share moves as a few rows.
    """
    each = found.select("doc_id", "text_hash", "owner", F.explode(F.concat("base", "tokens")["hash"]).alias("hash"))
    by_owner = each.distinct().groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    return by_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_documents"))


def scan_secrets(docs: DataFrame, owner: str = "source", copied_from: int = 2) -> DataFrame:
    """(doc_id, text_hash, base, spans), one row for each row of ``docs(doc_id, text, <owner>)``.

    ``base`` holds the spans of the three shapes, ``spans`` these and the tokens that look live;
    both are arrays of (start, order, end, kind, hash, live) in order of start and kind.
    Positions count code points, ends are exclusive. A candidate is live if fewer than
    ``copied_from`` owners have it. Tokens that overlap a base span are not added.

    A null text is an empty one and has no spans. Rows without owner belong to one unnamed
    owner. Repeated rows have the same spans. Rows without doc_id keep a null. An empty table
    gives none. Other columns are not read.
    """
    found = cut(candidates(docs, owner))
    some = found.where((F.size("base") > 0) | (F.size("tokens") > 0))
    owners = cut(ownership(some))
    live = cut(owners.where(F.col("n_owners") < copied_from).select("hash"))
    exploded = some.select("doc_id", "text_hash", F.explode(F.concat("base", "tokens")["hash"]).alias("hash"))
    live_here = cut(exploded.distinct().join(live, "hash").groupBy("doc_id", "text_hash").agg(F.collect_set("hash").alias("live")))
    here = live_here.withColumnsRenamed({"doc_id": "id2", "text_hash": "hash2"})
    joined = found.join(here, F.col("doc_id").eqNullSafe(F.col("id2")) & (F.col("text_hash") == F.col("hash2")), "left")
    owned = F.coalesce("live", F.array().cast("array<string>"))

    def marked(s: Column) -> Column:
        return F.struct(s["start"], s["order"], s["end"], s["kind"], s["hash"], F.array_contains(F.col("owned"), s["hash"]).alias("live"))

    flagged = joined.withColumn("owned", owned).select(
        "doc_id", "text_hash", F.transform("base", marked).alias("base"), F.transform("tokens", marked).alias("tokens")
    )
    added = F.filter("tokens", lambda s: s["live"])
    return flagged.select("doc_id", "text_hash", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def joined_spans(spans: str) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def redacted(docs: DataFrame, owner: str = "source") -> DataFrame:
    """``docs`` with every live secret replaced by a mark; ``n_chars`` follows if it is there.

    Copied examples stay, and so does every document.
    """
    scanned = scan_secrets(docs, owner)
    live = scanned.select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.filter("spans", lambda s: s["live"]).alias("__live")
    )
    live = cut(live.where(F.size("__live") > 0).dropDuplicates(["__id", "__hash"]))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))) == F.col("__hash"))
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def replace(acc: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        new = F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, F.lit(MARK))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), new.alias("out"))

    def whole(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(F.col("text"), (acc["at"] + 1).cast("int"), F.lit(2**31 - 1)))

    columns = docs.columns
    joined = docs.join(live, same, "left")
    text = F.when(F.col("__live").isNull(), F.col("text")).otherwise(F.aggregate("__live", begin, replace, whole))
    out = joined.withColumn("__text", text)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.when(F.col("__live").isNull(), F.col("n_chars")).otherwise(F.length("__text").cast("long")))
    return out.select(*[F.col("__text").alias(c) if c == "text" else F.col(c) for c in columns])
