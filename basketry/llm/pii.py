"""Personal data: patterns that are given, and identifiers that their contexts lead to.

The given patterns find emails, IP addresses, cards and phones. These are the seeds of a bootstrap: the two
words before a seed are a lexical pattern, the token that follows a pattern elsewhere is an instance. Patterns
and instances form a bipartite graph with counts, on which scores go to and fro for some rounds: a
pattern is as sure as the share of its occurrences anywhere that lead to a seed or a sure instance, an instance is
as sure as its patterns together. Sure instances then stand as seeds themselves: the words before them, wherever they
occur, are new patterns, and the graph grows until no pattern is new or ``INDUCTIONS`` times. Instances of sure
patterns that look like an identifier are added. Built-in functions only.

A search for the places of patterns goes through all texts, but only places of candidates are counted and shuffled.

The given expressions are written so that they find what their plain forms find, leftmost and not
overlapping, in linear time and without recursion: a run is taken whole and looked at from its start only.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.tables import columns, cut

_LOCAL = "[A-Za-z0-9._%+-]"
#: In the order in which spans of one start are listed.
KINDS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What tells texts apart in which an expression can't match.
_NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}

#: Different seeds a pattern needs.
SUPPORT = 3
#: Rounds of scoring, and the score from which patterns and instances count.
ROUNDS, SURE = 6, 0.8
#: How often patterns are sought before sure instances; each time costs two searches of the texts.
INDUCTIONS = 3
#: A pattern's two words lie within so many characters before a seed; longer ones are none.
_CONTEXT_CHARS = 80
#: Stands for the space between two groups of digits while texts are split into tokens.
_GLUE = "\ue000"
#: Candidate patterns that are broadcast; more are joined by sorting.
BROADCAST_PATTERNS = 500_000


def _luhn(digits: Column) -> Column:
    def value(i: Column) -> Column:
        digit = F.substr(digits, -i, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return F.when(i % 2 == 0, doubled).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + value(i))
    return total % 10 == 0


def valid(kind: str, match: Column) -> Column:
    """Whether a match of a kind's expression is one of the kind."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        def small(part: Column) -> Column:
            value = F.ltrim(part, F.lit("0"))
            return (F.length(value) < 3) | ((F.length(value) == 3) & (value <= "255"))

        return F.forall(F.split(match, r"\."), small)
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    return F.length(digits).between(10, 15)


def _located(text: Column, expression: str, matches: Column) -> Column:
    """Array of struct (start, value): matches with their place, from the lengths of what lies between."""
    between = F.split(text, expression, -1)
    nothing = F.array().cast("array<struct<start:int,value:string>>")
    walked = F.aggregate(
        F.arrays_zip(matches.alias("m"), F.slice(between, 1, F.size(matches)).alias("b")),
        F.struct(F.lit(0).alias("at"), nothing.alias("found")),
        lambda state, x: F.struct(
            (state["at"] + F.length(x["b"]) + F.length(x["m"])).alias("at"),
            F.array_append(
                state["found"], F.struct((state["at"] + F.length(x["b"])).alias("start"), x["m"].alias("value"))
            ).alias("found"),
        ),
        lambda state: state["found"],
    )
    return F.when(F.size(matches) > 0, walked).otherwise(nothing)


def _key(text: Column) -> Column:
    return F.struct(F.xxhash64(text).alias("a"), F.hash(text).alias("b"))


def given_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, key (hashes of the text), spans.

    ``spans`` is an array of struct (start, place of the kind, kind, end, value, before), sorted; ``before`` is the
    text just before the span. A NULL text counts as empty.
    """
    rows = columns(docs, doc_id=doc_id, text=text).withColumn("text", F.coalesce("text", F.lit("")))
    none = F.array().cast("array<string>")
    digit = F.col("text").rlike("[0-9]")
    for kind, expression in KINDS.items():
        # A text without the sign that a kind needs, or without digits, is not searched.
        can = F.contains("text", F.lit(_NEEDS[kind])) & (F.lit(True) if kind == "email" else digit)
        rows = rows.withColumn(f"m_{kind}", F.when(can, F.regexp_extract_all("text", F.lit(expression), 0)).otherwise(none))
    for kind, expression in KINDS.items():
        rows = rows.withColumn(f"l_{kind}", _located(F.col("text"), expression, F.col(f"m_{kind}")))

    def spans(kind: str, place: int) -> Column:
        good = F.filter(f"l_{kind}", lambda x: valid(kind, x["value"]))
        return F.transform(good, lambda x: F.struct(
            x["start"].alias("start"), F.lit(place).alias("place"), F.lit(kind).alias("kind"),
            (x["start"] + F.length(x["value"])).alias("end"), x["value"].alias("value"),
            # A blank stands for the beginning of the text, so that a word that is cut off is no word.
            F.concat(
                F.when(x["start"] <= _CONTEXT_CHARS, " ").otherwise(""),
                F.substr(F.col("text"), F.greatest(x["start"] - _CONTEXT_CHARS, F.lit(0)) + 1, F.least(x["start"], F.lit(_CONTEXT_CHARS))),
            ).alias("before"),
        ))

    every = F.concat(*[spans(kind, i) for i, kind in enumerate(KINDS)])
    some = F.size(F.concat(*[F.col(f"m_{kind}") for kind in KINDS])) > 0
    found = F.when(some, F.array_sort(every))
    kind_of = "array<struct<start:int,place:int,kind:string,end:int,value:string,before:string>>"
    return rows.select("doc_id", _key(F.col("text")).alias("key"), F.coalesce(found, F.array().cast(kind_of)).alias("spans"))


def _tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[ \t\n\x0B\f\r]+"), "")


def _glued(text: Column) -> Column:
    """The text with groups of digits that one space separates made one token; no place moves."""
    return F.regexp_replace(text, r"\x20(?<=[0-9)]\x20)(?=[0-9(])", _GLUE)


def _core(token: Column) -> Column:
    """The token without marks at its ends."""
    return F.regexp_replace(token, r"^[^\p{L}\p{N}+]+|[^\p{L}\p{N}]+$", "")


def _looks_like_identifier(core: Column) -> Column:
    """Has a digit or an at sign, at least five characters, and is nothing that was judged before.

    What the expressions of emails, IP addresses and phones match was found or rejected there; so was a number
    of as many digits as a card. Other numbers were judged by no expression, however long.
    """
    plain = F.translate(core, _GLUE, " ")
    shape = (F.length(core) >= 5) & core.rlike("[0-9@]")
    for kind in ("email", "ip", "phone"):
        shape = shape & ~plain.rlike(KINDS[kind])
    numbers = F.regexp_extract_all(plain, F.lit(KINDS["card"]), 0)
    return shape & ~F.exists(numbers, lambda x: F.length(F.regexp_replace(x, "[^0-9]", "")).between(14, 19))


def seed_contexts(given: DataFrame) -> DataFrame:
    """(kind, context, value, n): how often the two tokens are before a given span's value."""
    spans = given.select("key", F.explode("spans").alias("s")).distinct()
    white, word = r"[ \t\n\x0B\f\r]", r"[^ \t\n\x0B\f\r]"
    before = F.regexp_extract(_glued(F.col("s.before")), rf"{white}({word}+{white}+{word}+){white}+$", 1)
    context = F.array_join(_tokens(before), " ")
    near = spans.select("s.kind", context.alias("context"), F.lower("s.value").alias("value")).where("context <> ''")
    return near.groupBy("kind", "context", "value").agg(F.count(F.lit(1)).alias("n"))


def patterns_of(contexts: DataFrame, support: int = SUPPORT) -> DataFrame:
    """(kind, context, seeds): the contexts that enough different values follow; ``seeds`` are given ones only."""
    supported = contexts.groupBy("kind", "context").agg(
        F.count_distinct("value").alias("values"), F.sum(F.when(F.col("is_given"), F.col("n")).otherwise(0)).alias("seeds")
    )
    return supported.where(F.col("values") >= support).select("kind", "context", "seeds")


def _places(docs: DataFrame) -> DataFrame:
    """(key, at, h, x, y, value): each token after two others, x and y, ``h`` being a hash of those.

    ``at`` is the number of the token; ``value`` is its core if that looks like an identifier, else NULL.
    """
    tokens = docs.select(_key(F.col("text")).alias("key"), _tokens(_glued(F.col("text"))).alias("t"))
    n = F.greatest(F.size("t") - 2, F.lit(0))
    in_a_row = F.arrays_zip(F.slice("t", 1, n).alias("x"), F.slice("t", 2, n).alias("y"), F.slice("t", 3, n).alias("z"))
    rows = tokens.select("key", F.posexplode(in_a_row).alias("at", "w"))
    core = _core(F.col("w.z"))
    value = F.when(F.col("w.z").rlike("[0-9@]"), F.when(_looks_like_identifier(core), core))
    return rows.select("key", (F.col("at") + 2).alias("at"), F.xxhash64("w.x", "w.y").alias("h"), "w.x", "w.y", value.alias("value"))


def _hashed(contexts: DataFrame) -> DataFrame:
    parts = F.split("context", " ")
    return contexts.select("context", F.xxhash64(parts[0], parts[1]).alias("h"))


def _possible(rows: DataFrame, contexts: DataFrame) -> DataFrame:
    """``rows`` whose two words may be one of the contexts: all that are, and few others.

    The contexts' hashes are bits of a small array, which is a constant of the filter. With more than
    ``BROADCAST_PATTERNS`` contexts all rows may be.
    """
    hashes = _hashed(contexts).select("h").limit(BROADCAST_PATTERNS + 1).toArrow().column("h").to_numpy()
    if len(hashes) > BROADCAST_PATTERNS:
        return rows
    words = 1 << max(4, (len(hashes) // 4).bit_length())  # sixteen bits for each context at least
    bits = np.zeros(words * 64, np.uint8)
    bits[(hashes >> 6 & words - 1) * 64 + (hashes & 63)] = 1
    listed = ",".join(map(str, np.packbits(bits, bitorder="little").view("<i8").tolist()))
    word = F.shiftright("h", 6).bitwiseAND(F.lit(words - 1)).cast("int")
    bit = F.getbit(F.get(F.split(F.lit(listed), ",").cast("array<bigint>"), word), F.col("h").bitwiseAND(F.lit(63)).cast("int"))
    return rows.where(bit == 1)


def _with_context(rows: DataFrame, contexts: DataFrame) -> DataFrame:
    """``rows`` whose two words are one of the contexts, with ``context``."""
    known = _hashed(contexts)
    if contexts.count() <= BROADCAST_PATTERNS:
        known = F.broadcast(known)
    return rows.join(known, "h").where(F.col("context") == F.concat_ws(" ", "x", "y")).drop("x", "y")


def _followers(docs: DataFrame, contexts: DataFrame) -> DataFrame:
    """(context, value, n): how often a context is followed by an identifier, or by none (NULL).

    Places that can't be of a context go where they are made. The others are counted in each partition and then
    together, so that the join gets a row for each pair and not one for each place.
    """
    counted = _possible(_places(docs), contexts).groupBy("h", "x", "y", "value").agg(F.count(F.lit(1)).alias("n"))
    return _with_context(counted, contexts).select("context", "value", "n")


def _contexts_of(docs: DataFrame, values: DataFrame) -> DataFrame:
    """(kind, context, value, n): how often the two tokens are before one of the values, wherever it occurs."""
    if values.count() <= BROADCAST_PATTERNS:
        values = F.broadcast(values)
    places = _places(docs).where("value is not null")
    context = F.concat_ws(" ", "x", "y")
    return places.join(values, "value").groupBy("kind", context.alias("context"), "value").agg(F.count(F.lit(1)).alias("n"))


def _none(rows: DataFrame) -> DataFrame:
    return rows.sparkSession.createDataFrame([], "context string, value string, n long")


def score(patterns: DataFrame, followers: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Scores (kind, context, sure) of patterns and (kind, value, sure) of instances that are no seeds.

    ``patterns`` has kind, context, seeds; ``followers`` has context, value (NULL: no identifier), n.
    """
    totals = followers.groupBy("context").agg(F.sum("n").alias("total"))
    counted = cut(patterns.join(totals, "context").select("kind", "context", "seeds", "total"), "patterns")
    edges = followers.where("value is not null").join(counted.select("kind", "context"), "context")
    edges = cut(edges.select("kind", "context", "value", "n"), "edges")
    sure = counted.withColumn("sure", F.col("seeds") / F.greatest("total", "seeds"))
    instances = None
    for _ in range(rounds):
        # An instance is wrong only if all its patterns are.
        doubt = F.sum(F.log(F.greatest(1 - F.col("sure"), F.lit(1e-12))))
        instances = cut(
            edges.join(sure.select("kind", "context", "sure"), ["kind", "context"])
            .groupBy("kind", "value").agg((1 - F.exp(doubt)).alias("sure")),
            "instances",
        )
        gained = edges.join(instances, ["kind", "value"]).groupBy("kind", "context").agg(
            F.sum(F.col("n") * F.col("sure")).alias("gained")
        )
        more = (F.col("seeds") + F.coalesce("gained", F.lit(0.0))) / F.greatest("total", "seeds")
        sure = cut(
            counted.join(gained, ["kind", "context"], "left").withColumn("sure", F.least(more, F.lit(1.0))).drop("gained"),
            "sure",
        )
    return sure.select("kind", "context", "sure"), instances


def discovered(docs: DataFrame, given: DataFrame, text: str = "text", support: int = SUPPORT, sure: float = SURE) -> DataFrame:
    """(key, found): spans (start, place, kind, end) that sure patterns and instances add to ``given``.

    They don't overlap a given span of their text. Where several kinds fit, the surest does, then the first.
    """
    rows = columns(docs, text=text).where("text is not null")
    seen = cut(seed_contexts(given).withColumn("is_given", F.lit(True)), "seeds")
    patterns = cut(patterns_of(seen, support), "candidates")
    counts = cut(_followers(rows, patterns.select("context").distinct()) if not patterns.isEmpty() else _none(rows), "followers")
    pattern_scores, instance_scores = score(patterns, counts)
    known = None
    for _ in range(INDUCTIONS):
        found = instance_scores.where(F.col("sure") >= sure).select("kind", "value")
        new = cut(found if known is None else found.join(known, ["kind", "value"], "left_anti"), "new")
        if new.isEmpty():
            break
        known = new if known is None else cut(known.union(new), "known")
        seen = cut(seen.unionByName(_contexts_of(rows, new).withColumn("is_given", F.lit(False))), "seen")
        more = cut(patterns_of(seen, support), "candidates")
        fresh = cut(more.select("context").distinct().join(patterns.select("context").distinct(), "context", "left_anti"), "fresh")
        if not fresh.isEmpty():
            counts = cut(counts.unionByName(_followers(rows, fresh)), "followers")
        patterns = more
        pattern_scores, instance_scores = score(patterns, counts)
    contexts = pattern_scores.where(F.col("sure") >= sure)
    values = instance_scores.where(F.col("sure") >= sure).withColumnRenamed("sure", "value_sure")
    pairs = counts.where("value is not null").join(contexts, "context").join(values, ["kind", "value"])
    place = F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)]), F.col("kind"))
    best = pairs.groupBy("context", "value").agg(
        F.min(F.struct((-F.col("value_sure")).alias("less"), place.alias("place"), "kind")).alias("best")
    )
    best = cut(best.select("context", "value", "best.place", "best.kind"), "best")
    # With nothing to add, no row passes the join below; the texts are then not gone through for places.
    again = rows if not best.isEmpty() else rows.where(F.lit(False))
    found = _possible(_places(again).where("value is not null"), best.select("context").distinct())
    hits = _with_context(found, best.select("context").distinct()).drop("h").join(best, ["context", "value"]).distinct()
    hits = cut(hits, "hits")
    texts = again.select(_key(F.col("text")).alias("key"), _glued(F.col("text")).alias("text")).join(hits.select("key").distinct(), "key", "left_semi")
    placed = hits.join(texts.groupBy("key").agg(F.min("text").alias("text")), "key")
    # The tokens before are taken whole, one after the other, so that a long text needs no recursion.
    lead = F.concat(F.lit(r"^(?:[ \t\n\x0B\f\r]*+[^ \t\n\x0B\f\r]++){"), F.col("at").cast("string"), F.lit(r"}+[ \t\n\x0B\f\r]*+"))
    begin = F.length(F.call_function("regexp_extract", F.col("text"), lead, F.lit(0)))
    token = F.regexp_extract(F.expr("substr(text, begin + 1)"), r"^[^ \t\n\x0B\f\r]++", 0)
    marks = F.length(F.regexp_extract("token", r"^[^\p{L}\p{N}+]*", 0))
    spans = placed.withColumn("begin", begin).withColumn("token", token).select(
        "key", (F.col("begin") + marks).alias("start"), "place", "kind", _core(F.col("token")).alias("value")
    )
    spans = spans.withColumn("end", F.col("start") + F.length("value"))
    taken = given.where(F.size("spans") > 0).select("key", F.explode("spans").alias("s")).select("key", "s.start", "s.end").distinct()
    free = spans.alias("n").join(
        taken.alias("g"),
        (F.col("n.key") == F.col("g.key")) & (F.col("n.start") < F.col("g.end")) & (F.col("g.start") < F.col("n.end")),
        "left_anti",
    )
    return free.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("start", "place", "kind", "end"))).alias("found"))


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, base (given spans) and spans (with the discovered ones).

    Both are arrays of struct (start, place, kind, end), sorted; places are code points, ends exclusive. A NULL
    text counts as empty and has none.
    """
    given = cut(given_spans(docs, doc_id, text), "given")
    added = cut(discovered(docs, given, text), "discovered")
    slim = F.transform("spans", lambda x: F.struct(
        x["start"].alias("start"), x["place"].alias("place"), x["kind"].alias("kind"), x["end"].alias("end")
    ))
    rows = given.select("doc_id", "key", slim.alias("base")).join(added, "key", "left")
    return rows.select("doc_id", "base", F.when(F.col("found").isNull(), F.col("base")).otherwise(
        F.array_sort(F.concat("base", "found"))
    ).alias("spans"))
