"""License scan: ordered signature rules over whole texts, in Spark's own expressions.

A text becomes its words (ASCII letters lowered).  A prefilter looks the words up among
the rules' keywords and picks the texts that can match at all, and in these the rules
whose own keyword is there.  Those run in order of priority, over the words with a blank
on both sides of each; every rule replaces what it finds by a mark.  What lies inside an interval found by a rule of higher priority is gone when
later rules run, so contained detections are suppressed, and overlaps go to the earlier
rule.  Everything happens inside the row: no shuffle, no explosion, linear in the text.

A name that is denied ("not licensed under …") is the label ``denied`` and nothing else.  Short names such as MIT or
MPL-2.0 count behind words that say they are a license.

Null text counts as empty (no words, no labels, score 0).  Rows are kept as they are.  Columns with names
of the results are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagledger.llm.license_rules import BASE, Rule, ordered_rules

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE_SCORE = 0.6


def plain_words(text: Column) -> Column:
    """Words of the text with one blank between them.

    lower() does more than A-Z, but of all other letters only the Kelvin sign becomes an
    ASCII letter by itself; it is made another symbol first.
    """
    lowered = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u24da")))
    return F.trim(F.regexp_replace(lowered, SEPARATORS, " "))


def word_count(spaced: Column) -> Column:
    blanks = F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit("")))
    return (blanks / 2).cast("bigint")


def _spaced(phrase: str) -> str:
    return "".join(f" {w} " for w in phrase.split())


def _masked(spaced: Column, keywords: Column, rules: list[Rule]) -> Column:
    """The text with every detection replaced by the number of its rule."""
    table = F.array(
        *[
            F.struct(
                F.lit(r.keyword).alias("keyword"),
                F.lit(r.also).alias("also"),
                F.lit(r.pattern).alias("pattern"),
                F.lit(f" \x01{i}\x01 ").alias("mark"),
            )
            for i, r in enumerate(rules, 1)
        ]
    )
    both = lambda r: (r["also"] == "") | F.array_contains(keywords, r["also"])
    gated = F.filter(table, lambda r: F.array_contains(keywords, r["keyword"]) & both(r))
    return F.aggregate(gated, spaced, lambda t, r: F.regexp_replace(t, r["pattern"], r["mark"]))


def scan_licenses(df: DataFrame, text: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """Add n_words, n_base, first_word, last_word, base_labels, labels, score, detections.

    ``detections`` is the array of rule labels in text order; the others are as the
    module says.  Columns of these names are replaced.
    """
    rules = rules or ordered_rules()
    known = sorted({r.keyword for r in rules} | {r.also for r in rules if r.also} | {w for phrase in BASE for w in phrase.split()})
    words = df.withColumn("_plain", plain_words(F.col(f"`{text}`")))
    words = words.withColumn("_split", F.split("_plain", " "))
    words = words.withColumns(
        {
            "_words": F.when(F.col("_plain") == "", 0).otherwise(F.size("_split")).cast("bigint"),
            "_keywords": F.array_intersect("_split", F.array(*map(F.lit, known))),
        }
    ).drop("_split")
    possible = F.size("_keywords") > 0
    padded = F.concat(F.lit(" "), F.replace("_plain", F.lit(" "), F.lit("  ")), F.lit(" "))
    words = words.withColumn("_spaced", F.when(possible, padded).otherwise(""))
    spaced, total = F.col("_spaced"), F.col("_words")
    places, firsts, lasts = [], [], []
    for phrase in BASE:
        own = _spaced(phrase)
        here = F.contains(spaced, F.lit(own))
        rest = F.length(spaced) - F.length(F.replace(spaced, F.lit(own), F.lit("")))
        places.append(F.when(here, (rest / len(own)).cast("bigint")).otherwise(F.lit(0)))
        before = F.substring_index(spaced, own, 1)
        after = F.substring_index(spaced, own, -1)
        firsts.append(F.when(here, word_count(before)))
        lasts.append(F.when(here, total - word_count(after) - len(phrase.split())))
    found = words.withColumns(
        {
            "_places": F.array(*places),
            "_firsts": F.array(*firsts),
            "_lasts": F.array(*lasts),
            "_marks": F.regexp_extract_all(
                F.when(possible, _masked(spaced, F.col("_keywords"), rules)).otherwise(""), F.lit("\x01([0-9]+)\x01"), F.lit(1)
            ).cast("array<int>"),
        }
    )
    labels = F.array(*[F.lit(r.label) for r in rules])
    scores = F.array(*[F.lit(r.score) for r in rules])
    named = [F.when(F.col("_places")[i] > 0, F.lit(label)) for i, label in enumerate(BASE.values())]
    base = F.array_compact(F.array(*named))
    detections = F.transform("_marks", lambda i: F.element_at(labels, i))
    strongest = F.array_max(F.transform("_marks", lambda i: F.element_at(scores, i)))
    listed = found.withColumns({"_base": base, "detections": detections, "_strongest": strongest})
    listed = listed.withColumns(
        {
            "n_words": F.col("_words"),
            "n_base": F.aggregate("_places", F.lit(0).cast("bigint"), lambda a, b: a + b),
            "first_word": F.array_min("_firsts"),
            "last_word": F.array_max("_lasts"),
            "base_labels": F.concat_ws(",", F.array_sort("_base")),
            "labels": F.concat_ws(",", F.array_sort(F.array_union("_base", "detections"))),
            "score": F.greatest(
                F.coalesce("_strongest", F.lit(0.0)), F.when(F.size("_base") > 0, BASE_SCORE).otherwise(0.0)
            ),
        }
    )
    return listed.drop("_plain", "_keywords", "_spaced", "_words", "_places", "_firsts", "_lasts", "_marks", "_base", "_strongest")


def license_report(docs: DataFrame) -> DataFrame:
    found = scan_licenses(docs.select("doc_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


def license_sql() -> str:
    """The same in DuckDB's SQL: the rules run one after another in a recursive query."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    rules = ordered_rules()
    listed = ",\n".join(
        f"({i}, {quote(r.label)}, {quote(f' {r.keyword} ')}, {quote(f' {r.also} ' if r.also else ' ')}, {quote(r.pattern)}, chr(32) || chr(1) || '{i}' || chr(1) || chr(32), {r.score}::double)"
        for i, r in enumerate(rules, 1)
    )
    count = lambda s: f"((length({s}) - length(replace({s}, ' ', ''))) // 2)"
    place, first, last, label = [], [], [], []
    for phrase, name in BASE.items():
        own = quote(_spaced(phrase))
        place.append(f"((length(t) - length(replace(t, {own}, ''))) // {len(_spaced(phrase))})")
        first.append(f"CASE WHEN contains(t, {own}) THEN {count(f'string_split(t, {own})[1]')} END")
        last.append(
            f"CASE WHEN contains(t, {own}) THEN {count('t')} - {count(f'string_split(t, {own})[-1]')} - {len(phrase.split())} END"
        )
        label.append(f"CASE WHEN contains(t, {own}) THEN '{name}' END")
    keywords = "|".join(sorted({r.keyword for r in rules}))
    return f"""
    WITH RECURSIVE rules(i, label, keyword, also, pattern, mark, score) AS (VALUES {listed}),
    plain AS (
      SELECT doc_id, row_number() OVER () AS r,
             trim(regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SEPARATORS}', ' ', 'g'), ' ') AS p
      FROM documents),
    spaced AS (SELECT doc_id, r, CASE WHEN p = '' THEN '' ELSE ' ' || replace(p, ' ', '  ') || ' ' END AS t FROM plain),
    masked(r, i, t) AS (
      SELECT r, 0, t FROM spaced WHERE regexp_matches(t, ' (?:{keywords}) ')
      UNION ALL
      SELECT m.r, u.i, CASE WHEN contains(p.t, u.keyword) AND contains(p.t, u.also) THEN regexp_replace(m.t, u.pattern, u.mark, 'g') ELSE m.t END
      FROM masked m JOIN rules u ON u.i = m.i + 1 JOIN spaced p ON p.r = m.r),
    marks AS (
      SELECT r, unnest(regexp_extract_all(t, '\\x01([0-9]+)\\x01', 1))::int AS i
      FROM masked WHERE i = {len(rules)}),
    found AS (SELECT r, list_distinct(list(label)) AS labels, max(score) AS score FROM marks JOIN rules USING (i) GROUP BY r),
    base AS (
      SELECT doc_id, r, {count('t')} AS n_words, {' + '.join(place)} AS n_base,
             least({', '.join(first)}) AS first_word, greatest({', '.join(last)}) AS last_word,
             list_filter([{', '.join(label)}], lambda x: x IS NOT NULL) AS base
      FROM spaced)
    SELECT doc_id, n_words::bigint AS n_words, n_base::bigint AS n_base, first_word::bigint AS first_word,
           last_word::bigint AS last_word, array_to_string(list_sort(base), ',') AS base_labels,
           array_to_string(list_sort(list_distinct(list_concat(base, coalesce(labels, [])))), ',') AS labels,
           greatest(coalesce(score, 0.0), CASE WHEN len(base) > 0 THEN {BASE_SCORE} ELSE 0.0 END)::double AS score
    FROM base LEFT JOIN found USING (r)
    """
