"""Secret scans with multipart credential linking, in DataFrame expressions only.

Base spans are the matches of three fixed patterns. Access identifiers, secrets
and endpoints are parts of one credential; parts that are weak on their own (an id
assignment, a bare 40-character token, an endpoint) are reported only where a
complementary part lies in the same scope: its start is at most SCOPE characters
away. Weak matches that overlap a base span are part of it. The interval join deals parts to cells of SCOPE characters, so a part meets those of
three cells only, and a semi-join keeps a part once however many partners it has.

Positions are code points. Texts never move: matches leave the scan as rows.

Defined cases: null and empty texts have no spans; a null id is kept; repeated
rows come back as often as they went in; an empty table gives an empty result;
equal starts are ordered by kind; texts are taken whole; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relievo.plans.storage import materialize
from relievo.plans.text import text_or_empty

#: Kinds in order, with their patterns. Fixed values for the first three.
PATTERNS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{12,}",
    "hex": r"[0-9a-f]{32,}",
    "weak_id": r"""(?i:(?:access|client|account|tenant|key)[_-]?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_-]{6,}""",
    "weak_secret": r"[A-Za-z0-9/+]{40,}",
    "endpoint": r"""https?://[A-Za-z0-9.-]+[^\x20\x09-\x0D"'<>]*""",
}
KINDS = list(PATTERNS)
BASE = KINDS[:3]
LEAST_ASSIGNED = 8
SCOPE = 400
#: Which kinds complete a weak part.
COMPLETES = {
    "weak_id": ("assign", "hex", "weak_secret"),
    "weak_secret": ("access", "weak_id", "endpoint"),
    "endpoint": ("access", "weak_id", "assign"),
}


#: What a text with a match has to hold: strings in lower case, or a long run.
_NEEDS = {
    "assign": ("password", "passwd", "secret", "token", "api"), "access": ("akia",), "weak_id": ("access", "client", "account", "tenant", "key"), "endpoint": ("http",),
}
_LONG_RUN = r"(?<![A-Za-z0-9/+])[A-Za-z0-9/+]{32}"


def _possible(kind: str, low: Column, long_run: Column) -> Column:
    """A cheap test that no text with a match fails, before its pattern is tried."""
    if kind in ("hex", "weak_secret"):
        return long_run
    found = F.lit(False)
    for part in _NEEDS[kind]:
        found = found | F.contains(low, F.lit(part))
    return found


def _matches(text: Column, kind: str) -> Column:
    """An array of (kind, place, gap before, length, whether it counts)."""
    pattern = F.lit(PATTERNS[kind])
    found = F.arrays_zip(
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("m"), F.split(text, PATTERNS[kind], -1).alias("g"),
        (F.regexp_extract_all(text, pattern, F.lit(2)) if kind == "assign" else F.array().cast("array<string>")).alias("v"),
    )
    counts = {"assign": lambda x: F.length(x["v"]) >= LEAST_ASSIGNED, "weak_secret": lambda x: F.length(x["m"]) == 40}
    rows = F.transform(
        F.filter(found, lambda x: x["m"].isNotNull()),
        lambda x, i: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), i.alias("i"), F.length(x["g"]).cast("long").alias("gap"),
            F.length(x["m"]).cast("long").alias("len"), counts.get(kind, lambda _: F.lit(True))(x).alias("ok"),
        ),
    )
    return F.when(_possible(kind, F.col("low"), F.col("long_run")) & F.rlike(text, pattern), rows)


def _key() -> Column:
    """A key of a document's id and text."""
    text, doc = text_or_empty(), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    return F.concat_ws(":", doc, F.hex(F.xxhash64(text)), F.hex(F.hash(text)))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), _key().alias("key"))


def parts(docs: DataFrame) -> DataFrame:
    """``(key, kind, start, stop)`` of every match of every kind, once for each key."""
    text = F.col("text")
    seen = _keyed(docs).withColumns({"low": F.lower("text"), "long_run": F.rlike("text", F.lit(_LONG_RUN))})
    rows = seen.select("key", F.flatten(F.array_compact(F.array(*(_matches(text, k) for k in KINDS)))).alias("all"))
    rows = rows.select("key", F.inline("all")).groupBy("key", "kind", "i").agg(*(F.first(c).alias(c) for c in ("gap", "len", "ok")))
    so_far = Window.partitionBy("key", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stop = F.sum(F.col("gap") + F.col("len")).over(so_far)
    placed = rows.select("key", "kind", (stop - F.col("len")).alias("start"), stop.alias("stop"), "ok")
    return placed.where("ok").drop("ok")


def _cell(c: str) -> Column:
    return F.floor(F.col(c) / SCOPE)


def _near(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` that a row of ``right`` starts at most SCOPE characters away from."""
    spread = right.select(F.col("key").alias("key_r"), F.col("start").alias("start_r"), F.explode(F.sequence(_cell("start") - 1, _cell("start") + 1)).alias("cell_r"))
    on = (F.col("key") == F.col("key_r")) & (_cell("start") == F.col("cell_r")) & (F.abs(F.col("start_r") - F.col("start")) <= SCOPE)
    return left.join(spread, on, "left_semi")


def _apart(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` that no row of ``right`` overlaps."""
    cells = F.explode(F.sequence(_cell("start"), _cell("stop")))
    spread = right.select(F.col("key").alias("key_r"), F.col("start").alias("start_r"), F.col("stop").alias("stop_r"), cells.alias("cell_r"))
    on = (F.col("key") == F.col("key_r")) & (F.col("cell") == F.col("cell_r")) & (F.col("start_r") < F.col("stop")) & (F.col("start") < F.col("stop_r"))
    hit = left.withColumn("cell", cells).join(spread, on, "left_semi").select("key", "kind", "start").distinct()
    return left.join(hit, ["key", "kind", "start"], "left_anti").select(left.columns)


def spans(docs: DataFrame) -> DataFrame:
    """``(key, kind, start, stop)`` of base spans and of weak parts that others complete."""
    found = materialize(parts(docs), "parts")  # the texts are read once
    base = found.where(F.col("kind") < len(BASE))
    weak = _apart(found.where(F.col("kind") >= len(BASE)), base)
    usable = base.unionByName(weak)
    linked = base
    for kind, others in COMPLETES.items():
        ours = weak.where(F.col("kind") == KINDS.index(kind))
        partners = usable.where(F.col("kind").isin([KINDS.index(o) for o in others]))
        linked = linked.unionByName(_near(ours, partners))
    return linked


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)`` of every document."""
    name = F.element_at(F.array(*(F.lit(k) for k in KINDS)), F.col("kind") + 1)
    rows = spans(docs).select("key", F.struct("start", "kind", F.concat_ws(":", name, "start", "stop").alias("at")).alias("s"))
    told = lambda xs: F.array_join(F.transform(xs, lambda x: x["at"]), ",")
    found = rows.groupBy("key").agg(
        *(F.count_if(F.col("s.kind") == i).alias(f"n_{k}") for i, k in enumerate(BASE)), F.array_sort(F.collect_list("s")).alias("s")
    )
    found = found.select("key", *(f"n_{k}" for k in BASE), told(F.filter("s", lambda x: x["kind"] < len(BASE))).alias("base"), told(F.col("s")).alias("spans"))
    ids = _keyed(docs).select("doc_id", "key").join(found, "key", "left")
    return ids.select(
        "doc_id", *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"),
    )


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """The documents with every span replaced by ``mark``; columns and rows as they were.

    Overlapping spans are replaced as one. ``n_chars``, where there is one,
    follows the new text; null texts stay null. Texts that cannot hold a match
    are told by a cheap test and do not take part in the join.
    """
    low, long_run, possible = F.lower(text_or_empty()), F.rlike(text_or_empty(), F.lit(_LONG_RUN)), F.lit(False)
    for kind in KINDS:
        possible = possible | _possible(kind, low, long_run)
    keyed = docs.where(possible).withColumn("__key", _key())
    # what stays before each span that begins where all before it have ended
    before = Window.partitionBy("key").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    rows = spans(docs.select("doc_id", "text")).withColumn("from", F.coalesce(F.max("stop").over(before), F.lit(0)))
    gaps = F.array_sort(F.collect_list(F.when(F.col("start") >= F.col("from"), F.struct("from", "start"))))
    held = rows.groupBy(F.col("key").alias("__key")).agg(gaps.alias("__gaps"), F.max("stop").alias("__last"))
    joined = keyed.join(held, "__key", "left")
    piece = lambda g: F.substring(F.col("text"), (g["from"] + 1).cast("int"), (g["start"] - g["from"]).cast("int"))
    rest = F.substring(F.col("text"), (F.col("__last") + 1).cast("int"), F.length("text"))
    clean = F.col("__gaps").isNull()
    out = joined.withColumn("text", F.when(clean, F.col("text")).otherwise(F.concat(F.array_join(F.transform("__gaps", piece), mark), F.lit(mark), rest)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(clean, F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.select(*docs.columns).unionByName(docs.where(~possible))
