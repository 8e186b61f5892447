"""Secrets in texts, and who owns them; DataFrame functions only.

A text is split at the matches of each pattern: the lengths of the parts between them give the places. Only matches
leave the scan. Candidate values are hashed and counted over distinct repositories and owners of the whole corpus: a
value that several owners or many repositories hold is a copied example; one in a few of a single owner looks live.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamfold.session import stored


@dataclass(frozen=True)
class Pattern:
    """``value`` is the group of the pattern that holds the secret; ``least`` its characters at least.

    A pattern that is not ``base`` only proposes: its spans count if the value looks live.
    """

    kind: str
    regex: str
    value: int = 0
    least: int = 0
    base: bool = True


#: Fixed values. Runs shorter than the least length are dropped after matching where an earlier, too short match can
#: hide a later one (assign); elsewhere the length is part of the pattern, which finds the same runs.
PATTERNS = [
    Pattern("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Pattern("access", r"AKIA[A-Z0-9]{16,}"),
    Pattern("hex", r"[0-9a-f]{24,}"),
    Pattern("opaque", r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*[0-9])(?=[0-9_-]*[A-Za-z])[A-Za-z0-9_-]{20,}", base=False),
]


#: Most repositories of one owner in which a value still looks live.
FEW = 10


def live(owners: Column, repositories: Column) -> Column:
    """Whether a value with so many distinct holders looks live, and not like a copied example."""
    return (owners == 1) & (repositories <= FEW)


def _found(text: Column, pattern: Pattern) -> Column:
    """Per match: characters between the one before and it, its own characters, and its value."""
    matches = F.regexp_extract_all(text, F.lit(pattern.regex), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern.regex), F.lit(pattern.value)) if pattern.value else matches
    gaps = F.transform(F.split(text, pattern.regex, -1), lambda gap: F.length(gap))
    zipped = F.arrays_zip(gaps.alias("gap"), F.transform(matches, lambda m: F.length(m)).alias("size"), values.alias("value"))
    # most texts have no match: one search decides
    none = F.lit(None).cast("array<struct<gap:int,size:int,value:string>>")
    return F.when(text.rlike(pattern.regex), F.filter(zipped, lambda m: m["size"].isNotNull())).otherwise(none)


def secret_spans(docs: DataFrame, owner: str = "source", repository: str = "doc_id", keep: tuple[str, ...] = ("doc_id",), text: str = "text", patterns: list[Pattern] = PATTERNS) -> DataFrame:
    """The columns ``keep`` with ``spans``: ``start, order, kind, stop, owners, repositories``, sorted.

    Places are code points from 0, ``stop`` is exclusive, ``order`` is the pattern's place in the list. Matches of a
    pattern are leftmost and do not overlap each other. ``owners`` and ``repositories`` count the distinct holders of
    the value in all documents (nulls are one holder). Spans of patterns that only propose are left out where the
    value is not ``live`` or a base span overlaps. A null text is empty; rows stay, repeated ones too; an
    empty table gives an empty table. A kept column named ``spans`` is an error.
    """
    if "spans" in keep:
        raise ValueError("column spans is added by the scan")
    content = F.coalesce(F.col(text), F.lit(""))
    kept = [F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep)]
    scanned = docs.select(*kept, F.xxhash64(F.col(owner).isNull(), F.col(owner)).alias("owner"), F.xxhash64(F.col(repository).isNull(), F.col(repository)).alias("repository"), *[_found(content, p).alias(p.kind) for p in patterns])
    rows = stored(scanned.withColumn("row", F.monotonically_increasing_id()), "secret-rows")

    each = F.array(*[F.struct(F.lit(i).alias("order"), F.col(p.kind).alias("found")) for i, p in enumerate(patterns)])
    kinds = rows.where(F.coalesce(*[F.col(p.kind).isNotNull() for p in patterns]) if len(patterns) == 1 else F.expr(" OR ".join(f"`{p.kind}` IS NOT NULL" for p in patterns)))
    kinds = kinds.select("row", "owner", "repository", F.inline(each))
    matches = kinds.select("row", "owner", "repository", "order", F.posexplode("found").alias("n", "m")).select("row", "owner", "repository", "order", "n", "m.*")
    upto = Window.partitionBy("row", "order").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    placed = matches.withColumn("stop", F.sum((F.col("gap") + F.col("size")).cast("long")).over(upto))
    least = F.element_at(F.array(*[F.lit(p.least) for p in patterns]), F.col("order") + 1)
    placed = placed.where(F.length("value") >= least).select("row", "owner", "repository", "order", (F.col("stop") - F.col("size")).alias("start"), "stop", F.sha2("value", 256).alias("value"))
    candidates = stored(placed, "secret-candidates")

    # one row per value and holder first, so that a value copied everywhere is counted in parts
    holders = candidates.groupBy("value", "owner", "repository").agg(F.lit(1).alias("_one"))
    owned = holders.groupBy("value", "owner").agg(F.count("*").alias("repositories")).groupBy("value").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))
    known = candidates.join(owned, "value")
    names, is_base = F.array(*[F.lit(p.kind) for p in patterns]), F.array(*[F.lit(p.base) for p in patterns])
    span = F.struct("start", "order", F.element_at(names, F.col("order") + 1).alias("kind"), "stop", "owners", "repositories")
    marked = known.withColumn("base", F.element_at(is_base, F.col("order") + 1)).where(F.col("base") | live(F.col("owners"), F.col("repositories")))
    # the furthest end of base spans begun before, and the first begin of those after: does one overlap?
    before = Window.partitionBy("row").orderBy("start", "order").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("row").orderBy("start", "order").rowsBetween(1, Window.unboundedFollowing)
    marked = marked.withColumns({"_end": F.max(F.when(F.col("base"), F.col("stop"))).over(before), "_next": F.min(F.when(F.col("base"), F.col("start"))).over(after)})
    free = F.coalesce(F.col("_end") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("_next") >= F.col("stop"), F.lit(True))
    per_row = marked.where(F.col("base") | free).groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    empty = F.array().cast(per_row.schema["spans"].dataType)
    return rows.join(per_row, "row", "left").select(*[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)], F.coalesce("spans", empty).alias("spans"))


def redacted(docs: DataFrame, mask: str = "[secret]", owner: str = "source", repository: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with spans of values that look live replaced by ``mask``; copied examples stay."""
    held = secret_spans(docs.select(F.struct("*").alias("row"), F.col(text).alias("content"), F.col(owner).alias("owner"), F.col(repository).alias("repository")), "owner", "repository", ("row",), "content")
    masked = F.filter("spans", lambda s: live(s["owners"], s["repositories"]))
    body = F.col(f"row.`{text}`")
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def cut(state: Column, s: Column) -> Column:
        # a span inside what was replaced already adds nothing
        fresh = F.concat(state["out"], F.substring(body, (state["at"] + 1).cast("int"), F.greatest(s["start"] - state["at"], F.lit(0)).cast("int")), F.when(s["start"] >= state["at"], F.lit(mask)).otherwise(F.lit("")))
        return F.struct(fresh.alias("out"), F.greatest(state["at"], s["stop"]).alias("at"))

    done = F.aggregate(masked, start, cut, lambda s: F.concat(s["out"], F.substring(body, (s["at"] + 1).cast("int"), F.length(body))))
    return held.select(*[(F.when(F.size(masked) > 0, done).otherwise(body) if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
