"""Quality rules: a table of thresholds compiled into one projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyweave.llm.rows import SPACE_CHARACTERS, SPACES, let, text_of, words

SYMBOLS = "#*$%&|<>"

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "for", "it", "with", "on", "by", "are", "was", "this", "be",
    "le", "la", "les", "de", "des", "du", "et", "que", "qui", "un", "une", "en", "pour", "par", "dans", "au",
    "der", "die", "das", "und", "ist", "den", "von", "zu", "mit", "nicht", "ein", "eine", "auf", "im", "für",
    "el", "los", "las", "y", "a", "se", "del", "por", "con", "una", "no", "su", "para", "es",
)


@dataclass(frozen=True)
class Rule:
    """Passes while ``low`` <= ``part`` <= ``high``, both per 100 of ``whole`` if that is given; in whole numbers."""

    name: str
    part: str
    whole: str | None = None
    low: int | None = None
    high: int | None = None

    def tests(self) -> list[str]:
        part, whole = (f"100 * {self.part}", f" * {self.whole}") if self.whole else (self.part, "")
        low = [] if self.low is None else [f"{part} >= {self.low}{whole}"]
        return low if self.high is None else [*low, f"{part} <= {self.high}{whole}"]


RULES = (
    Rule("symbols", "n_symbols", "n_words", high=10),
    Rule("shouts", "n_shouts", "n_words", high=20),
    Rule("word_length", "word_chars", "n_words", low=250, high=1200),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=50),
    Rule("stop_words", "n_stop_words", low=2),
)

MIN_WORDS = 50
MAX_REPEATED = 50


def _characters(text: Column, characters: str) -> Column:
    """How many of these ASCII characters stand in the text."""
    without = lambda c: F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit("")))
    return sum((without(c) for c in characters), F.lit(0))


def _repeated_words(array: Column) -> Column:
    """Words inside 3-word windows that occur twice or more, first occurrences included.

    Windows are compared by 64-bit hashes; only texts where two are equal get them sorted.
    """

    def covered(ordered: Column) -> Column:
        again = lambda x, j: (F.get(ordered, j - 1)["h"] == x["h"]) | (F.get(ordered, j + 1)["h"] == x["h"])
        places = F.transform(F.filter(ordered, again), lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))
        return F.size(F.array_distinct(F.flatten(places)))

    def count(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(placed, covered))

    def hashed(w: Column) -> Column:
        first = F.slice(w, F.lit(1), F.size(w) - 2)
        return F.transform(first, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    return let(array, lambda w: F.when(F.size(w) >= 4, let(hashed(w), count)).otherwise(0))


def quality_columns(text: Column) -> dict[str, Column]:
    """Measures of one text; null measures like an empty text."""
    text = text_of(text)
    with_word = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACE_CHARACTERS)) != "")
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    counted = let(
        words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            _repeated_words(w).cast("long").alias("n_repeat_words"),
            F.size(F.array_intersect(stop, w)).cast("long").alias("n_stop_words"),
        ),
    )
    lines = let(
        with_word,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_lines"),
            (F.size(w) - F.size(F.array_distinct(w))).cast("long").alias("n_dup_lines"),
        ),
    )
    return {
        "_counted": counted,
        "_lines": lines,
        "word_chars": (F.length(text) - _characters(text, SPACE_CHARACTERS)).cast("long"),
        "n_symbols": _characters(text, SYMBOLS).cast("long"),
        "n_shouts": ((F.octet_length(text) - F.octet_length(F.replace(text, F.lit("!!"), F.lit("")))) / 2).cast("long"),
    }


MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shouts", "n_stop_words",
)


def judge_quality(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, out: str = "quality") -> DataFrame:
    """Attach the struct ``out``: all measures, ``base_failed``, ``failed_rules`` and ``kept``.

    One projection over the rows, no shuffle and no user function. Empty and null texts have no
    words and fail the base rule; ratios over nothing pass, the rule of stop words does not. Rows, repeated or not, are judged each
    by itself. Other columns stay as they are; one named like ``out`` is replaced.
    """
    measured = quality_columns(F.col(f"_in.`{text}`"))
    kept = [c for c in docs.columns if c != out]
    # A one-row generator: filters on the verdict would otherwise be moved below with every measure written out.
    once = F.inline(F.array(F.struct(*[v.alias(k) for k, v in measured.items()])))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_in")).select("_in", once)
    counted = [F.col(f"_counted.{c}") for c in ("n_words", "n_repeat_words", "n_stop_words")]
    inner = rows.select("_in", *counted, "_lines.*", "word_chars", "n_symbols", "n_shouts")
    failed_base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)
    failed = F.array_compact(F.array(*[F.when(~F.expr(" AND ".join(rule.tests())), F.lit(rule.name)) for rule in rules]))
    judged = inner.select("_in", *MEASURES, failed_base.alias("base_failed"), failed.alias("failed_rules"))
    verdict = F.struct(
        *MEASURES, "base_failed", "failed_rules", (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept")
    )
    return judged.select(*[F.col(f"_in.`{c}`") for c in kept], verdict.alias(out))


def keep_quality(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rows that the rules keep, with their columns as they came."""
    judged = judge_quality(docs, text, rules, out="_quality")
    return judged.where("_quality.kept").select(*[F.col(f"`{c}`") for c in docs.columns])


_SPACE_CLASS = "[^\\x20\\x09-\\x0D]+"


def quality_sql(table: str = "documents") -> str:
    """The same verdicts in SQL."""
    tests = ["NOT base_failed"]
    tests += [test for rule in RULES for test in rule.tests()]
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_SPACE_CLASS}') AS w
               FROM {table}),
lined AS (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_SPACE_CLASS}')) AS l,
                 list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS s
          FROM texts),
repeated AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n_repeat_words
             FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
                   FROM (SELECT doc_id, x, i, count(*) OVER (PARTITION BY doc_id, x) AS n
                         FROM (SELECT doc_id, unnest(s) AS x, generate_subscripts(s, 1) AS i FROM lined))
                   WHERE n > 1)
             GROUP BY doc_id),
measured AS (
    SELECT doc_id, len(w)::BIGINT AS n_words,
           length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
           (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
           coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines,
           ((length(t) - length(replace(t, '!!', ''))) // 2)::BIGINT AS n_shouts,
           len(list_intersect(w, [{stop}]))::BIGINT AS n_stop_words
    FROM lined LEFT JOIN repeated USING (doc_id)),
based AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM measured)
SELECT doc_id, {', '.join(MEASURES)}, base_failed, {' AND '.join(tests)} AS kept FROM based"""
