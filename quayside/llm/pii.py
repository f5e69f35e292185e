"""Personal data: base patterns, and identifiers that the contexts of known ones give away.

All of it is DataFrame work. The base kinds are found with regular expressions, written so that Java's matcher
never tries a run of characters twice. Then entities that the base patterns know are seeds: the
two words before them are lexical patterns. Patterns and entities form a graph, scored in
rounds: a pattern is as good as the mean confidence of its distinct entities of a
kind, and an entity is as good as its patterns together (noisy or). An entity that no base pattern
matches, but that stands in a pattern of high confidence, is a discovered identifier. It is a seed for further
patterns from then on, and all its mentions are reported, whatever stands before them. Rounds end when
``ROUNDS`` of them brought no new pattern; scores only grow, so they do end.

Only mentions (runs of words with a digit or @) are exploded, never words; patterns and
entities are reduced before they are joined, so that a frequent context is one row.

A null or empty text has no spans. Rows are kept one for one; the rows of a repeated or null id are told apart
by a hash of their text. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import small_batches, snapshot

# Fixed values of the base kinds. (?:\G|(?<!x)) lets a run of x start only where it begins or
# where the last match ended; no other start in it can match if this one does not.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain for a pattern to be tried.
_HINTS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
#: A run of words with a digit or @.
MENTION = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?:\x20[^\s0-9@]*+[0-9@]\S*+)*+"
#: Characters before a mention in which its two words of context are looked for.
CONTEXT_CHARS = 64
ROUNDS = 3
#: What a pattern needs to discover: distinct seeds (known or discovered), and confidence.
LEAST_SEEDS = 5
CONFIDENCE = 0.8
#: Entities of no kind that every pattern is taken to have seen besides its own.
DOUBT = 1.0

_SPANS = "array<struct<start:int,end:int,value:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def worth(digit: Column, place: Column) -> Column:
        twice = digit.cast("int") * 2
        return F.when(place % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(digit.cast("int"))

    each = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda d: d != ""), worth)
    return F.aggregate(each, F.lit(0), lambda total, x: total + x) % 10 == 0


def _valid_ip(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda part: F.coalesce(part.try_cast("bigint") <= 255, F.lit(False)))


def _valid_card(value: Column) -> Column:
    digits = _digits(value)
    return F.length(digits).between(16, 19) & _luhn(digits)


VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda value: F.lit(True),
    "ip": _valid_ip,
    "card": _valid_card,
    "phone": lambda value: F.length(_digits(value)).between(8, 15),
}


def _placed(matches: Column, gaps: Column) -> Column:
    """Spans of matches, from the texts of the matches and of what lies between them."""

    def put(state: Column, found: Column) -> Column:
        start = state["at"] + found["gap"]
        end = start + F.length(found["value"])
        span = F.struct(start.alias("start"), end.alias("end"), found["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    steps = F.transform(
        matches, lambda m, k: F.struct(m.alias("value"), F.coalesce(F.length(F.get(gaps, k)), F.lit(0)).alias("gap"))
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))
    return F.aggregate(steps, start, put, lambda state: state["spans"])


def with_spans(rows: DataFrame, text: str, patterns: dict[str, str], hints: dict[str, str]) -> DataFrame:
    """``rows`` with a column of spans for each pattern; positions are code points, ends exclusive."""
    none = F.array().cast("array<string>")
    for kind, pattern in patterns.items():
        hint = hints.get(kind)
        tried = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        rows = rows.withColumn(f"_m_{kind}", F.when(F.contains(F.col(text), F.lit(hint)), tried).otherwise(none) if hint else tried)
    for kind, pattern in patterns.items():
        found = F.col(f"_m_{kind}")
        spans = F.when(F.size(found) > 0, _placed(found, F.split(F.col(text), pattern, -1)))
        rows = rows.withColumn(kind, F.coalesce(spans, F.array().cast(_SPANS)))
    return rows.drop(*(f"_m_{kind}" for kind in patterns))


def _valid(kind: str) -> Column:
    return F.filter(kind, lambda s: VALID[kind](s["value"]))


def base_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """(id, mark, one column of spans for each base kind, mention) for every row; mark tells texts apart.

    With ``keep`` also row, all columns of the row.
    """
    small_batches(docs.sparkSession)
    text = F.col(text_col).cast("string")
    kept_row = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if keep else []
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("mark"), F.coalesce(text, F.lit("")).alias("text"), *kept_row
    )
    found = with_spans(rows, "text", {**PATTERNS, "mention": MENTION}, _HINTS)
    kept = [F.when(F.size(k) > 0, _valid(k)).otherwise(F.col(k)).alias(k) for k in KINDS]
    # the words before a mention are taken from the text here, so that it need not go further
    contexts = F.transform(
        "mention",
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            s["value"].alias("value"),
            F.substring("text", F.greatest(s["start"] - CONTEXT_CHARS, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT_CHARS))).alias("before"),
        ),
    )
    contexts = F.when(F.size("mention") > 0, contexts).otherwise(F.array().cast("array<struct<start:int,end:int,value:string,before:string>>"))
    return found.select("id", "mark", *kept, contexts.alias("mention"), *(["row"] if keep else []))


def _kind_of(value: Column) -> Column:
    """The base kind that a whole value is of, or null."""
    kind = F.lit(None).cast("string")
    for name in reversed(KINDS):
        whole = value.rlike("^(?:" + PATTERNS[name].replace(r"\G|", "") + ")$")
        kind = F.when(whole & VALID[name](value), F.lit(name)).otherwise(kind)
    return kind


def mentions(found: DataFrame) -> DataFrame:
    """(id, mark, start, end, value, pattern, kind) for every mention; pattern is null without two words before it."""
    rows = found.where(F.size("mention") > 0).select("id", "mark", F.explode("mention").alias("m")).select("id", "mark", "m.*")
    # brackets, quotes and stops around a mention are not part of it
    core = F.regexp_extract("value", r"^[^0-9A-Za-z@+]*+(.*?)[^0-9A-Za-z@]*$", 1)
    lead = F.length(F.regexp_extract("value", r"^[^0-9A-Za-z@+]*+", 0))
    words = F.regexp_extract_all(F.lower("before"), F.lit(r"[^\s]+"), F.lit(0))
    rows = rows.select("id", "mark", (F.col("start") + lead).alias("start"), core.alias("value"), words.alias("words"))
    # no index of a slice may be negative, whatever Spark evaluates first
    last = F.slice("words", F.greatest(F.size("words") - 1, F.lit(1)), 2)
    pattern = F.when(F.size("words") >= 2, F.array_join(last, " "))
    rows = rows.where(F.length("value") > 0)
    rows = rows.select("id", "mark", "start", (F.col("start") + F.length("value")).alias("end"), "value", pattern.alias("pattern"))
    return rows.withColumn("kind", _kind_of(F.col("value")))


def _able(graph: DataFrame, sizes: DataFrame, found: DataFrame | None, least_seeds: int) -> DataFrame:
    """(pattern, kind, entities) of the patterns with enough seeds of a kind: base ones, and those discovered so far."""
    seeds = graph.where("seed is not null").select("pattern", F.col("seed").alias("kind"))
    if found is not None:
        seeds = seeds.unionByName(graph.join(found, "value").select("pattern", "kind"))
    seeds = seeds.groupBy("pattern", "kind").agg(F.count("*").alias("seeds"))
    return seeds.where(F.col("seeds") >= least_seeds).join(sizes, "pattern").select("pattern", "kind", "entities")


def discovered(found: DataFrame, rounds: int = ROUNDS, least_seeds: int = LEAST_SEEDS, confidence: float = CONFIDENCE) -> DataFrame:
    """(id, mark, kind, start, end) of mentions that only their contexts, or those of their value elsewhere, give away."""
    rows = snapshot(mentions(found), "mentions")
    # the graph: each entity and pattern that occur together, once
    graph = rows.where("pattern is not null").groupBy("pattern", "value").agg(F.max("kind").alias("seed"))
    graph = snapshot(graph, "graph")
    sizes = snapshot(graph.groupBy("pattern").agg(F.count("*").alias("entities")), "sizes")
    identifier = (F.length(_digits(F.col("value"))) >= 4) | F.contains(F.col("value"), F.lit("@"))
    able = snapshot(_able(graph, sizes, None, least_seeds), "able")
    count, idle = able.count(), 0
    edges = entities = sure = None
    while idle < rounds:
        if not idle or edges is None:  # patterns were added
            edges = snapshot(graph.join(able, "pattern").select("pattern", "value", "seed", "kind"), "edges")
        known = F.when(F.col("seed") == F.col("kind"), 1.0).when(F.col("seed").isNotNull(), 0.0)
        trusted = edges if entities is None else edges.join(entities, ["value", "kind"], "left")
        trust = F.coalesce(known, F.lit(0.0) if entities is None else F.col("trust"), F.lit(0.0))
        weight = trusted.groupBy("pattern", "kind").agg(F.sum(trust).alias("trust"))
        scored = able.join(weight, ["pattern", "kind"])
        patterns = snapshot(scored.select("pattern", "kind", (F.col("trust") / (F.col("entities") + DOUBT)).alias("score")), "patterns")
        doubt = F.sum(F.log(1.000001 - F.col("score")))
        together = edges.where("seed is null").join(patterns, ["pattern", "kind"]).groupBy("value", "kind")
        entities = snapshot(together.agg((1 - F.exp(doubt)).alias("trust"), F.max("score").alias("score")), "entities")
        sure = snapshot(entities.where((F.col("score") >= confidence) & identifier).select("value", "kind", "score"), "sure")
        now = snapshot(_able(graph, sizes, sure.select("value", "kind"), least_seeds), "able")
        grown = now.count()
        idle = 0 if grown > count else idle + 1
        able, count = (now, grown) if grown > count else (able, count)
    new = rows.where(F.col("kind").isNull()).drop("kind").join(sure, "value")
    best = F.max_by("kind", F.struct("score", "kind")).alias("kind")
    return new.groupBy("id", "mark", "start", "end").agg(best)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, mark, email, ip, card, phone, more): base spans by kind, and discovered ones, by start.

    A discovered span that touches a base span of its row is not listed, since that data is known.
    """
    return _with_more(snapshot(base_spans(docs, id_col, text_col), "spans"))


def _with_more(found: DataFrame) -> DataFrame:
    """Written base spans with the discovered ones beside them."""
    new = discovered(found).groupBy("id", "mark").agg(
        F.array_sort(F.collect_set(F.struct("start", "end", "kind"))).alias("more")
    )
    new = snapshot(new, "discovered").withColumnsRenamed({"id": "_id", "mark": "_mark"})
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
    rows = found.drop("mention").join(new, same, "left").drop("_id", "_mark")
    base = F.concat(*KINDS)
    free = F.filter("more", lambda m: ~F.exists(base, lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    return rows.withColumn("more", F.coalesce(free, F.array().cast("array<struct<start:int,end:int,kind:string>>")))


def all_spans(kind: str) -> Column:
    """The base and discovered spans of a kind, by start."""
    own = F.transform(F.col(kind), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    more = F.filter("more", lambda m: m["kind"] == kind)
    return F.array_sort(F.concat(own, F.transform(more, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end")))))


def listed(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))


def redacted(text: Column, spans: Column) -> Column:
    """A text with each span replaced by its kind in brackets; spans (start, end, kind) by start, which may overlap."""

    def cut(state: Column, s: Column) -> Column:
        clean = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        label = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        added = F.when(s["start"] >= state["at"], F.array(clean, label)).otherwise(F.array().cast("array<string>"))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.concat(state["parts"], added).alias("parts"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    rest = F.aggregate(
        spans, start, cut, lambda s: F.concat(F.array_join(s["parts"], ""), F.substring(text, s["at"] + 1, F.length(text)))
    )
    return F.when(F.size(spans) > 0, rest).otherwise(text)


def _with_kind(kind: str) -> Column:
    return F.transform(
        all_spans(kind), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"))
    )


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all spans of their texts replaced by their kinds; columns unchanged.

    The rows are written once with their base spans, and only discovered spans are joined to them, so texts are not shuffled
    unless discovered spans are too many to be sent to all tasks.
    """
    found = _with_more(snapshot(base_spans(docs, id_col, text_col, keep=True), "rows"))
    spans = F.array_sort(F.concat(*map(_with_kind, KINDS)))
    text = F.col(f"row.`{text_col}`").cast("string")
    rows = found.select("row", spans.alias("cuts"))
    clean = F.when(F.size("cuts") > 0, redacted(text, F.col("cuts"))).otherwise(F.col(f"row.`{text_col}`"))
    return rows.select(*((clean if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns))
