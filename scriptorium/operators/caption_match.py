"""Dialogue units against caption events: an exact similarity join that never makes all pairs.

A pair can score only if it shares enough terms, if the unit's letters stand in the event's, or if a term of the
terminology names both.  For the first, terms are ranked by rarity and a unit meets an event on a term so rare in both
that the rest of either still holds the terms that the score asks for.  For the second, the gram of the unit with the
smallest hash meets the grams of all events.  Pairs travel as ids; what scores them is joined to the distinct pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.functions import text as t
from scriptorium.operators import phrases, scans
from scriptorium.operators.stored import Stored

# Scores, caps and lengths of the matching.
HIGH, MID, BY_TERM, PER_TERM, MOST_TERMS, BY_WORDS = 0.7, 0.6, 0.72, 0.05, 3, 0.65
SHORT, SHORT_SHARED, SHARED, LETTERS = 4, 2, 3, 16
PER_UNIT, BUDGET, RELEVANT = 2, 60, 80
ENDS_SPEECH = ("scene_heading", "transition", "format_marker", "page_heading")


def dialogue_units(entries: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, unit, speaker, n_entries, entry_ids, pages, source`` from ``keys, at, id, page, kind, text`` in order of ``at``.

    A unit is a run of dialogue, and of parentheticals or action that follow a cue; ``unit`` is the place it begins.
    """
    w = Window.partitionBy(*keys).orderBy("at")
    body, kind = F.trim(F.coalesce("text", F.lit(""))), F.col("kind")
    said = F.when(kind == "character", F.struct(F.nullif(body, F.lit("")).alias("name"))).when(kind.isin(*ENDS_SPEECH), F.struct(F.lit(None).cast("string").alias("name")))
    rows = entries.withColumn("body", body).withColumn("speaker", F.last(said, ignorenulls=True).over(w)["name"]).withColumn("before", F.lag("kind").over(w))
    led = kind.isin("parenthetical", "action") & F.col("speaker").isNotNull() & F.col("before").isin("character", "parenthetical") & (F.col("body") != "")
    rows = rows.withColumn("spoken", F.coalesce((kind == "dialogue") | led, F.lit(False)))
    rows = rows.withColumn("run", F.sum(F.when(F.col("spoken"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    parts = F.array_sort(F.collect_list(F.struct("at", "id", "page", "body")))
    units = rows.filter("spoken and body <> ''").groupBy(*keys, "run").agg(parts.alias("p"), F.first("speaker").alias("speaker"))
    each = lambda field: F.transform("p", lambda x: x[field])
    return units.select(*keys, F.col("p")[0]["at"].alias("unit"), "speaker", F.size("p").alias("n_entries"), each("id").alias("entry_ids"), F.array_distinct(each("page")).alias("pages"), F.array_join(each("body"), " ").alias("source"))


def score(inside: Column, n: Column, event_n: Column, shared: Column, n_terms: Column) -> Column:
    """0 to 1 for a unit and an event, both not empty.

    ``inside``: the unit's letters, LETTERS and more, stand in the event's; ``n, event_n, shared``: their terms and those of
    both; ``n_terms``: rows of the terminology that name both.
    """
    least, named = F.least(n, event_n), n_terms > 0
    ratio = shared / F.greatest(F.lit(1), least)
    ratio = F.when(shared >= SHARED, F.greatest(ratio, F.lit(BY_WORDS))).otherwise(ratio)
    ratio = F.when(named, F.greatest(ratio, F.lit(BY_TERM) + F.least(n_terms, F.lit(MOST_TERMS)) * F.lit(PER_TERM))).otherwise(ratio)
    return (
        F.when(inside, 1.0)
        .when(least == 0, F.when(named, BY_TERM).otherwise(0.0))
        .when(shared < F.when(n <= SHORT, SHORT_SHARED).otherwise(SHARED), F.when(named & (shared > 0), BY_TERM).otherwise(0.0))
        .when((n <= SHORT) & (shared < n), 0.0)
        .otherwise(ratio)
    )


def _ranked(side: DataFrame, key: str, frequency: Stored) -> DataFrame:
    """``key, word, place, n``: a row's words from the rarest on."""
    words = side.select(key, F.size("words").alias("n"), F.explode("words").alias("word")).join(frequency.side(), "word")
    return words.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy("often", "word")) - 1).drop("often")


def _by_words(units: DataFrame, events: DataFrame) -> DataFrame:
    """Pairs that share as many words as the score asks for: all of a short unit's, else SHARED."""
    word = lambda side: side.select(F.explode("words").alias("word"))
    frequency = Stored(word(units).unionAll(word(events)).groupBy("word").agg(F.count(F.lit(1)).alias("often")))
    asks = F.when(F.col("n") <= SHORT, F.col("n")).otherwise(SHARED)
    left = _ranked(units.filter(F.size("words") >= SHORT_SHARED), "unit_id", frequency).withColumn("asks", asks).filter(F.col("place") <= F.col("n") - F.col("asks"))
    right = _ranked(events, "event", frequency).select("event", "word", F.col("place").alias("event_place"), F.col("n").alias("event_n"))
    right = right.filter(F.col("event_place") <= F.col("event_n") - SHORT_SHARED)
    met = left.join(right, (left["word"] == right["word"]) & (F.col("event_place") <= F.col("event_n") - F.col("asks")))
    return met.select("unit_id", "event")


def _by_letters(units: DataFrame, events: DataFrame) -> DataFrame:
    """Pairs where a gram of the unit stands in the event: that with the smallest hash, which few others have.

    A unit stands in no event that is shorter, so grams are made of units no longer than the longest event.
    """
    grams = lambda c: F.regexp_extract_all(c, F.lit(f"(?=(.{{{LETTERS}}}))"), F.lit(1))  # noqa: E731  one pass, where substrings would begin anew at each place
    n = F.length("flat")
    longest = events.agg(F.max(n)).first()[0] or 0
    least = F.array_min(F.transform(grams(F.col("flat")), lambda g: F.struct(F.xxhash64(g).alias("h"), g.alias("g"))))["g"]
    left = units.filter(n.between(LETTERS, longest)).select("unit_id", least.alias("gram"), n.alias("n"))
    right = events.filter(n >= LETTERS).select("event", F.explode(F.array_distinct(grams(F.col("flat")))).alias("gram"), n.alias("event_n"))
    return left.join(right, "gram").filter("n <= event_n").select("unit_id", "event")


def _by_terms(units: DataFrame, events: DataFrame) -> DataFrame:
    """Pairs that a term names: its word in the unit, its rendering in the event."""
    named = units.select("unit_id", F.explode("named").alias("x")).select("unit_id", F.col("x.chinese").alias("phrase")).distinct()
    return named.join(phrases.phrase_hits(events, "event", "text", named, "phrase", False, False), "phrase").select("unit_id", "event")


def scored_pairs(units: DataFrame, events: DataFrame, terms: DataFrame, keys: list[str]) -> DataFrame:
    """``unit_id, event, start, end, text, score`` of all pairs that score MID and more, each once.

    ``units``: ``keys, unit_id, source``; ``events``: ``event, start, end, text``; ``terms``: ``keys, english, chinese``, of which a
    key has RELEVANT at most.  Ids must be unique.  Null or blank sources and texts match nothing.
    """
    text = t.collapse_space(F.col("text"))
    prepared = lambda c: [t.match_terms(c).alias("words"), t.compact_key(c).alias("flat")]
    listed = terms.filter("english <> '' and chinese <> ''").groupBy(*keys).agg(F.collect_list(F.struct(t.plain_lower(F.col("english")).alias("english"), "chinese")).alias("terms"))
    # the lower-cased source is an element, so it is made once a unit, not once a term
    named = F.transform(F.array(F.lower("source")), lambda low: F.filter("terms", lambda x: low.contains(x["english"])))[0]
    left = units.filter(t.has_match_key(F.col("source"))).join(Stored(listed).side(), keys, "left")  # a row a key, so a hot key is broadcast
    left = Stored(left.select("unit_id", "source", *prepared(F.col("source")), F.coalesce(named, F.array().cast("array<struct<english:string,chinese:string>>")).alias("named")))
    right = Stored(events.filter(text != "").select("event", "start", "end", text.alias("text"), *prepared(text)))
    pairs = _by_words(left.df, right.df).unionAll(_by_letters(left.df, right.df)).unionAll(_by_terms(left.df, right.df)).distinct()
    event = right.df.select("event", "start", "end", "text", F.col("words").alias("event_words"), F.col("flat").alias("event_flat"))
    event = F.broadcast(event) if right.side() is not right.df else event
    met = pairs.join(left.df.drop("source"), "unit_id").join(event, "event")  # ids meet the units first, so no event is shuffled with its text
    facts = F.struct(
        ((F.length("flat") >= LETTERS) & F.col("event_flat").contains(F.col("flat"))).alias("inside"),
        F.size("words").alias("n"), F.size("event_words").alias("event_n"),
        F.size(F.array_intersect("words", "event_words")).alias("shared"),
        F.size(F.filter("named", lambda x: F.col("text").contains(x["chinese"]))).alias("n_terms"),
    )
    # a filter on a column would be pushed below it and count the shared words anew wherever the score names them
    values = F.filter(F.transform(F.array(facts), lambda x: score(*(x[c] for c in ("inside", "n", "event_n", "shared", "n_terms")))), lambda v: v >= MID)
    return met.select("unit_id", "event", "start", "end", "text", F.explode(values).alias("score"))


def candidates(pairs: DataFrame) -> DataFrame:
    """The PER_UNIT best events of each unit, with ``rank``; ties go to the earlier event, then to its text."""
    place = Window.partitionBy("unit_id").orderBy(F.desc("score"), "start", "end", "text", "event")
    return pairs.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= PER_UNIT)


def emitted(units: DataFrame, best: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Units with ``n_candidates``, in ``order``, until BUDGET candidates are out; the unit that reaches it is the last."""
    counts = best.groupBy("unit_id").agg(F.count(F.lit(1)).alias("n_candidates"))
    counted = units.join(counts, "unit_id", "left").withColumn("n_candidates", F.coalesce("n_candidates", F.lit(0)))
    return scans.within_budget(counted, keys, order, F.col("n_candidates"), BUDGET)


def timestamps(sent: DataFrame, best: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, unit_id, event, start, end, confidence`` of emitted units with candidates.

    The only candidate of a unit is ``high`` if it scores HIGH and no other such unit claims its event; else the first
    candidate counts as ``low``.
    """
    rows = sent.select(*keys, "unit_id", "n_candidates").join(best.filter("rank = 1"), "unit_id").dropna(subset=["start", "end"])
    alone = (F.col("n_candidates") == 1) & (F.col("score") >= HIGH)
    claims = rows.filter(alone).groupBy(*keys, "event").agg(F.count(F.lit(1)).alias("claims"))
    return rows.join(claims, [*keys, "event"], "left").select(*keys, "unit_id", "event", "start", "end", F.when(alone & (F.col("claims") == 1), "high").otherwise("low").alias("confidence"))


def summary(units: DataFrame, sent: DataFrame, stamps: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: units, units included, candidates, unique and all timestamps; keys without a unit have no row."""
    n = units.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_units"))
    included = sent.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_included"), F.sum("n_candidates").alias("n_candidates"))
    stamped = stamps.groupBy(*keys).agg(F.count_if(F.col("confidence") == "high").alias("n_unique"), F.count(F.lit(1)).alias("n_timestamps"))
    none = F.lit(0)
    return n.join(included, keys, "left").join(stamped, keys, "left").select(*keys, "n_units", *[F.coalesce(c, none).alias(c) for c in ("n_included", "n_candidates", "n_unique", "n_timestamps")])
