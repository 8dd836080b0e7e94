"""Secrets by checked patterns and multipart credential linking, in DataFrame
functions only.

Base spans (``BASE``) are pattern matches with a check; they always stay. Three
further kinds are weak parts of a credential: an identifier (login, account,
mail address), a secret (a shorter or oddly named assignment, a password in a
URL, a long mixed token) and an endpoint (URL, host, IP address). A weak part
alone says nothing and is reported only where complementary parts co-occur: in
its scope (a paragraph: text without a blank line) and within ``reach`` code
points of it there is a secret beside another role, and either one of these is
a base span or all three roles are there. ``access`` counts as an identifier,
``assign`` and ``hex`` as secrets. A weak part that overlaps a base span is
part of that span and goes.

Matches get their places from the gaps between them: a text split at a
pattern and the matches of the pattern alternate, so running sums of lengths
and of paragraph breaks give each match's start and scope. Texts stay where
they are; only matches move. Parts and scopes are joined as intervals by
buckets of ``reach`` code points: a bucket is summed up as the lowest start and
the highest end of each role, which decides exactly whether an interval of its
neighbours meets one. So a weak part meets three rows at most, however dense
the text is.

Defined cases: a null or empty text has no spans; offsets are code points;
equal texts have equal spans; repeated rows and rows without an id are each
scanned on their own; an empty table gives no rows. Only the id and the text
are read. All patterns are linear in the text: runs are possessive or bounded,
and a run is entered at its first character only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabreg.llm.common import stored, text_or_empty

IDENTIFIER, SECRET, ENDPOINT = range(3)

# fixed values: the base patterns. Bounds of repeats and look-behinds of
# ``access`` and ``hex`` find the same spans as runs with a length check.
_ASSIGN = r"""(?i:(?:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?+)([A-Za-z0-9+/_.=-]++)"""
BASE = (("assign", SECRET, _ASSIGN), ("access", IDENTIFIER, r"AKIA[A-Z0-9]{16,}+"),
        ("hex", SECRET, r"(?<![0-9a-f])[0-9a-f]{24,}+"))
MIN_VALUE = 6

_GIVEN = r"""["']?\x20{0,8}[:=]\x20{0,8}["']?"""
_HOST = r"[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}\.){1,8}[A-Za-z]{2,24}"
WEAK = (
    ("identifier", IDENTIFIER, "|".join((
        rf"(?<![A-Za-z0-9])(?i:user(?:[_-]?(?:name|id))?|login|account|client[_-]?id|access[_-]?key(?:[_-]?id)?){_GIVEN}[A-Za-z0-9._@+-]{{2,128}}+",
        rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}+@{_HOST}",
        r"(?<=://)[^\s:/@]{1,64}+(?=:[^\s@/]{3,128}+@)"))),
    ("secret", SECRET, "|".join((
        rf"(?<![A-Za-z0-9])(?i:pass(?:word|wd|phrase)?|pwd|secret|token|api_?key|auth(?:orization)?|bearer|credentials?|private[_-]?key){_GIVEN}[^\s\"'<>,;]{{4,128}}+",
        # the first look-behind spares most positions the second, dear one
        r"(?<=[^\s:/@]:)(?<=://[^\s:/@]{1,64}:)[^\s:@/]{3,128}+(?=@)",
        r"(?<![A-Za-z0-9+/_=-])(?=[a-z0-9+/_=-]{0,127}[A-Z])(?=[A-Z0-9+/_=-]{0,127}[a-z])(?=[A-Za-z+/_=-]{0,127}[0-9])[A-Za-z0-9+/_=-]{20,128}+(?![A-Za-z0-9+/_=-])"))),
    ("endpoint", ENDPOINT, "|".join((
        r"(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s\"'<>/?#]{1,255}+",
        rf"(?<![A-Za-z0-9])(?i:host(?:[_-]?name)?|server|endpoint){_GIVEN}[A-Za-z0-9.:/_-]{{3,255}}+",
        r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?::[0-9]{1,5})?(?!\.?[0-9A-Za-z])"))))
KINDS = tuple(k for k, _, _ in BASE + WEAK)
_ROLES = [r for _, r, _ in BASE + WEAK]
_BREAK = r"\n(?:[\x20\t\r]*+\n)++"


def _matches(docs: DataFrame) -> DataFrame:
    """(key, id, kind, no, gap, breaks, size, value) of every match of every
    pattern; a row without a kind for a text without any."""
    patterns = [p for _, _, p in BASE + WEAK]
    # steps are columns of their own: an expression used twice would run twice
    secret = [k for k, r in enumerate(_ROLES) if r == SECRET]
    cut = docs.withColumns({f"p{k}": F.split("text", patterns[k], -1) for k in secret})
    # without any secret no weak part is reported: the others are not looked for
    some = F.greatest(*[F.size(f"p{k}") for k in secret]) > 1
    cut = cut.withColumns({f"p{k}": F.when(some | F.lit(k < len(BASE)), F.split("text", p, -1)).otherwise(F.array("text"))
                           for k, p in enumerate(patterns) if k not in secret})
    none = "array<struct<kind:int,no:int,gap:int,breaks:int,size:int,value:int>>"

    def hits(k: int, pattern: str) -> Column:
        gaps = F.col(f"p{k}")
        found = F.arrays_zip(F.slice(gaps, 1, F.size(gaps) - 1).alias("gap"),
                             F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("hit"))
        value = (lambda h: F.length(F.regexp_extract(h, pattern, 1))) if k == 0 else (lambda h: F.length(h))
        return F.when(F.size(gaps) > 1, F.transform(found, lambda x, i: F.struct(
            F.lit(k).alias("kind"), i.alias("no"), F.length(x["gap"]).alias("gap"),
            (F.size(F.split(x["gap"], _BREAK, -1)) - 1).alias("breaks"), F.length(x["hit"]).alias("size"),
            value(x["hit"]).alias("value")))).otherwise(F.array().cast(none))

    every = cut.select("key", "id", F.concat(*[hits(k, p) for k, p in enumerate(patterns)]).alias("m"))
    return every.select("key", "id", F.explode_outer("m").alias("m")).select("key", "id", "m.*")


def parts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, id, kind, start, end, scope, base) of all base spans and weak
    parts; texts without any have a row without a kind. ``key`` is a row's."""
    keyed = docs.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).alias("id"),
                        text_or_empty(text_col).cast("string").alias("text"))
    run = Window.partitionBy("key", "kind").orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    placed = (_matches(keyed)
              .withColumn("end", F.sum(F.col("gap") + F.col("size")).over(run))
              .withColumn("scope", F.sum("breaks").over(run))
              .withColumn("start", F.col("end") - F.col("size"))
              # a failing match is dropped here, after it has used its part of the text
              .filter(F.col("kind").isNull() | (F.col("kind") != 0) | (F.col("value") >= MIN_VALUE))
              .withColumn("base", F.col("kind") < len(BASE)))
    # base spans that begin at or before a part, and, in the other order, at or after it
    key = Window.partitionBy("key")
    up = key.orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    down = key.orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, 0)
    own = F.col("base")
    return (placed.withColumn("reached", F.max(F.when(own, F.col("end"))).over(up))
            .withColumn("begun", F.min(F.when(own, F.col("start"))).over(down))
            .filter(F.col("kind").isNull() | own | ~(
                F.coalesce(F.col("reached") > F.col("start"), F.lit(False))
                | F.coalesce(F.col("begun") < F.col("end"), F.lit(False))))
            .select("key", "id", "kind", "start", "end", "scope", "base"))


def linked(found: DataFrame, reach: int = 300) -> DataFrame:
    """The weak parts of ``parts`` that complement others in their scope."""
    role = F.element_at(F.array(*[F.lit(r) for r in _ROLES]), F.col("kind") + 1)
    some = found.filter(F.col("kind").isNotNull()).withColumn("role", role)
    buckets = F.sequence(F.floor(F.col("start") / reach), F.floor((F.col("end") - 1) / reach))
    tests = {str(r): F.col("role") == r for r in range(3)} | {"b": F.col("base")}
    place = ["key", "scope", "bucket"]
    # as many rows as there are buckets with parts, not pairs of parts
    sums = some.withColumn("bucket", F.explode(buckets)).groupBy(*place).agg(
        *[x for c, t in tests.items() for x in (F.min(F.when(t, F.col("start"))).alias(f"low{c}"),
                                                F.max(F.when(t, F.col("end"))).alias(f"high{c}"))])
    weak = some.filter(~F.col("base"))
    asked = weak.withColumn("own", F.floor(F.col("start") / reach)).withColumn(
        "bucket", F.explode(F.sequence(F.col("own") - 1, F.col("own") + 1)))
    met = asked.join(sums, place).groupBy("key", "kind", "start", "end").agg(*[F.max(
        (F.col(f"low{c}") <= F.col("start") + reach) & (F.col(f"high{c}") >= F.col("start") - reach)).alias(f"has{c}")
        for c in tests])
    here = {c: F.coalesce(F.col(f"has{c}"), F.lit(False)) for c in tests}
    roles = sum(here[str(r)].cast("int") for r in range(3))
    return met.filter(here[str(SECRET)] & (roles >= 2) & (here["b"] | (roles == 3))).select("key", "kind", "start", "end")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = 300) -> DataFrame:
    """(id, base, spans): arrays of (kind, start, end) by start, then kind."""
    found = stored(parts(docs, id_col, text_col), "secret-parts")
    base = found.filter(F.col("base") | F.col("kind").isNull()).select("key", "id", "kind", "start", "end")
    weak = linked(found, reach)
    ids = found.groupBy("key").agg(F.first("id").alias("id"))
    entry = F.when(F.col("kind").isNotNull(), F.struct("start", "kind", "end"))
    every = base.drop("id").unionByName(weak).groupBy("key").agg(F.sort_array(F.collect_list(entry)).alias("s"))
    names = F.array(*[F.lit(k) for k in KINDS])

    def named(spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(F.get(names, s["kind"]).alias("kind"), s["start"].cast("int").alias("start"),
                                                     s["end"].cast("int").alias("end")))

    nothing = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return (ids.join(every, "key", "left").withColumn("s", F.coalesce("s", nothing))
            .select("id", named(F.filter("s", lambda s: s["kind"] < len(BASE))).alias("base"), named(F.col("s")).alias("spans")))
