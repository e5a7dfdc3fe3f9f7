"""Secret scan with corpus-wide ownership, in DataFrame functions only.

Candidates are found by pattern; their hashes are then counted over the distinct repositories and owners
they occur in. A value that many owners hold is a copied example; one that a single owner holds looks live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import dealt_anew, saved, small

# The patterns of the kinds, each with its group that holds the value, and the least length of that group.
KINDS = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    "access": (r"(AKIA[A-Z0-9]+)", 1, 16),
    "hex": (r"([0-9a-f]{32,})", 1, 32),
    "owned": (r"([A-Za-z0-9+/_-]{24,})", 1, 24),
}
ORDER = {"assign": 0, "access": 1, "hex": 2, "owned": 3}
BLOCK = 256


def _may_hold(kind: str) -> Column:
    """Whether a text can have a match of a kind; cheaper than its pattern."""
    text = F.col("text")
    if kind == "assign":
        folded = F.lower(text)
        return folded.contains("passw") | folded.contains("secret") | folded.contains("token") | folded.contains("api")
    return text.contains("AKIA") if kind == "access" else text.rlike({"hex": "[0-9a-f]{32}", "owned": "[A-Za-z0-9+/_-]{24}"}[kind])


def candidates(docs: DataFrame, repository: str = "source", owner: str | None = None) -> DataFrame:
    """Every candidate as ``doc_id, row, repository, owner, kind, start, stop, value``; see ``scan``.

    One scan of the texts serves all kinds.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("row"), F.col(repository).cast("string").alias("repository"), F.col(owner or repository).cast("string").alias("owner"), "text")
    kept = ("doc_id", "row", "repository", "owner")
    each = [F.when(_may_hold(kind), F.struct(F.lit(kind).alias("kind"), F.regexp_extract_all("text", F.lit(pattern), 0).alias("whole"), F.split("text", pattern, -1).alias("gap"))) for kind, (pattern, _, _) in KINDS.items()]
    split = rows.select(*kept, F.explode(F.array_compact(F.array(*each))).alias("m")).select(*kept, "m.*").where(F.size("whole") > 0)
    # Advance of each match from the last one's end, then sums of blocks of matches, then starts.
    sized = split.withColumn("advance", F.transform("whole", lambda w, i: F.length(w) + F.length(F.get("gap", i))))
    n = F.ceil(F.size("whole") / BLOCK).cast("int")
    summed = sized.withColumn("sums", F.transform(F.sequence(F.lit(0), n - 1), lambda b: F.aggregate(F.slice("advance", b * BLOCK + 1, F.lit(BLOCK)), F.lit(0), lambda s, x: s + x)))
    blocks = summed.withColumn("heads", F.transform("sums", lambda _, b: F.aggregate(F.slice("sums", F.lit(1), b), F.lit(0), lambda s, x: s + x)))
    ended = blocks.withColumn("ends", F.transform("whole", lambda _, i: F.get("heads", F.floor(i / BLOCK).cast("int")) + F.aggregate(F.slice("advance", (F.floor(i / BLOCK) * BLOCK).cast("int") + 1, i % BLOCK + 1), F.lit(0), lambda s, x: s + x)))
    spans = ended.select(*kept, "kind", F.explode(F.arrays_zip("whole", "ends")).alias("m"))
    value, least = F.col("m.whole"), F.lit(0)
    for kind, (pattern, group, size) in KINDS.items():
        here = F.col("kind") == kind
        least = F.when(here, size).otherwise(least)
        if kind == "assign":  # of the others, the whole match is the value
            value = F.when(here, F.regexp_extract("m.whole", pattern, group)).otherwise(value)
    found = spans.select(*kept, "kind", (F.col("m.ends") - F.length("m.whole")).alias("start"), F.col("m.ends").alias("stop"), value.alias("value")).where(F.length("value") >= least)
    # Random-looking: digits and letters of both cases.
    return found.where((F.col("kind") != "owned") | (F.col("value").rlike("[0-9]") & F.col("value").rlike("[a-z]") & F.col("value").rlike("[A-Z]")))


def ownership(found: DataFrame) -> DataFrame:
    """Distinct repositories and owners of each candidate hash; equal rows are counted away before each shuffle."""
    pairs = found.groupBy("hash", "repository", "owner").agg(F.count(F.lit(1)).alias("n"))
    owners = pairs.groupBy("hash", "owner").agg(F.sum("n").alias("n"))
    repositories = pairs.groupBy("hash", "repository").agg(F.lit(1).alias("one"))
    counted = owners.groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_places"))
    return counted.join(repositories.groupBy("hash").agg(F.count(F.lit(1)).alias("n_repositories")), "hash")


def scan(docs: DataFrame, repository: str = "source", owner: str | None = None, copied: int = 3) -> DataFrame:
    """Spans of every whole text, with what the whole corpus says about their values.

    Returns ``doc_id, row, spans`` for rows with spans, where a span is ``(start, order, kind, stop, hash,
    n_repositories, n_owners, live)`` in code points, end exclusive, by start and kind. Kinds ``assign``,
    ``access`` and ``hex`` stand as their patterns find them; ``owned`` is a random-looking token outside
    those spans that a single owner holds. ``live`` holds where fewer than ``copied`` owners hold the value. Values are
    hashed, never returned. ``row`` tells texts under one id apart; equal rows share theirs. Null texts have
    no spans, null repositories and owners count as one of their own.
    """
    found = saved(candidates(docs, repository, owner).select("doc_id", "row", "repository", "owner", "kind", "start", "stop", F.sha2("value", 256).alias("hash")))
    known = found.join(dealt_anew(ownership(found)), "hash").where((F.col("kind") != "owned") | (F.col("n_owners") == 1))
    order = F.coalesce(*(F.when(F.col("kind") == k, F.lit(n)) for k, n in ORDER.items()))
    span = F.struct(F.col("start"), order.alias("order"), "kind", "stop", "hash", "n_repositories", "n_owners", (F.col("n_owners") < copied).alias("live"))
    rows = known.groupBy("doc_id", "row").agg(F.array_sort(F.collect_set(span)).alias("spans"))
    base = F.filter("spans", lambda s: s["kind"] != "owned")
    inside = lambda s: F.exists("base", lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"]))
    return rows.withColumn("base", base).withColumn("spans", F.filter("spans", lambda s: (s["kind"] != "owned") | ~inside(s))).drop("base")


def joined(spans: Column | str) -> Column:
    """Spans as kind:start:stop, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def _of_kind(kind: str):
    return lambda s: s["kind"] == kind


def digests(docs: DataFrame, repository: str = "source", owner: str | None = None) -> DataFrame:
    """``scan`` for every input row: counts of each base kind, digest of base spans, all spans, and how many look live or copied.

    Null and empty texts have no spans; null ids and repeated rows stay, texts of any length are taken whole,
    an empty table gives none. Columns but id, text, repository and owner are ignored.
    """
    spans = scan(docs, repository, owner).withColumnRenamed("doc_id", "id")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_row"))
    all_ = F.coalesce("spans", F.expr("cast(array() as array<struct<start:int,order:int,kind:string,stop:int,hash:string,n_repositories:bigint,n_owners:bigint,live:boolean>>)"))
    joined_rows = rows.join(spans, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_row") == F.col("row")), "left").withColumn("spans", all_)
    count = lambda test: F.size(F.filter("spans", test)).cast("bigint")
    return joined_rows.select(
        "doc_id",
        *(count(_of_kind(k)).alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(joined(F.filter("spans", lambda s: s["kind"] != "owned")), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
        count(lambda s: s["live"]).alias("n_live"),
        count(lambda s: ~s["live"]).alias("n_copied"),
    )


def masked(docs: DataFrame, repository: str = "source", owner: str | None = None, mask: str = "<secret>") -> DataFrame:
    """``docs`` with ``mask`` in place of every span that looks live; touching spans get one mask.

    Copied examples stay, texts without live spans are unchanged, null and empty texts too. Repeated rows and
    null ids stay, all columns are kept, whatever their names, and an empty table gives an empty one.
    """
    places = F.transform(F.filter("spans", lambda s: s["live"]), lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop")))
    live = scan(docs, repository, owner).select(F.col("doc_id").alias("masked_id"), F.col("row").alias("masked_row"), places.alias("masked_spans")).where(F.size("masked_spans") > 0)
    live = small(live, F.size("masked_spans") + 1)
    # The row stands in one column, so its names meet no others.
    rows = docs.select(F.struct(*docs.columns).alias("own_all"), F.col("doc_id").cast("bigint").alias("own_id"), F.xxhash64("text").alias("own_row"))
    rows = rows.join(live, F.col("own_id").eqNullSafe(F.col("masked_id")) & (F.col("own_row") == F.col("masked_row")), "left")
    text, start = F.col("own_all.text"), F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def add(done: Column, span: Column) -> Column:
        apart = span["start"] >= done["at"]
        more = F.when(apart, F.array(F.substring(text, done["at"] + 1, span["start"] - done["at"]), F.lit(mask))).otherwise(F.array().cast("array<string>"))
        return F.struct(F.greatest(done["at"], span["stop"]).alias("at"), F.concat(done["parts"], more).alias("parts"))

    rest = lambda done: F.concat(F.array_join(done["parts"], ""), F.substring(text, done["at"] + 1, F.length(text)))
    new = F.when(F.col("masked_spans").isNull(), text).otherwise(F.aggregate("masked_spans", start, add, rest))
    return rows.select(*(new.alias(c) if c == "text" else F.col("own_all")[c].alias(c) for c in docs.columns))
