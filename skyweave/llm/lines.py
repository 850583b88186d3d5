"""Line dedup by a deletion-neighbourhood join, with DataFrame functions only.

Two lines within one edit are P + x + S and P + y + S for some P and S, x and y being one character
or none. So a line emits, for every place, the key of (P, S) with its character there left out (its
deletion variants), or with none left out; lines that share a key are within one edit of each other,
and the earliest of a key decides for all of it, without pairs. A key has at most as many lines as
there are characters, so no key is hot.

To keep the keys few, a line is first cut into quarters: the edit lies in one of them, and what
stands before and after that quarter is equal. Only quarters whose surroundings stand in another
line too emit their variants.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyweave.llm.rows import SPACE_CHARACTERS, let, text_of
from skyweave.runtime import broadcast_checked, materialize

# Shorter lines match equal lines only: one edit changes too much of them.
MIN_CHARACTERS = 20

QUARTERS = 4

# Lengths are rounded down to whole steps, so that most lines have one set of quarters.
_STEP = 8

# Characters hashed at a time, so that the keys of a long line cost its length times this.
_BLOCK = 256

_LAST = (1 << 63) - 1


def _ends(length: Column, i: Column) -> tuple[Column, Column]:
    """Characters before and after a quarter, by the length rounded down to whole steps.

    ``i`` below four counts the quarters of the line's own length, from four on those of a line that is
    one longer; both lines of a pair have the longer one's quarters among these.
    """
    longer = length + (i / QUARTERS).cast("int")
    whole, quarter = longer - longer % _STEP, i % QUARTERS
    return (whole * quarter / QUARTERS).cast("int"), whole - (whole * (quarter + 1) / QUARTERS).cast("int")


def _surroundings(line: Column, min_characters: int) -> Column:
    """Hashes of what stands round each quarter, nulls where the longer length has the same quarters."""

    def around(n: Column) -> Column:
        def one(i: Column) -> Column:
            head, tail = _ends(n, i)
            text = F.xxhash64(i % QUARTERS, head, tail, F.substr(line, F.lit(1), head), F.substr(line, n - tail + 1, tail))
            return F.when((i < QUARTERS) | ((n + 1) % _STEP == 0), text)

        return F.transform(F.sequence(F.lit(0), F.lit(2 * QUARTERS - 1)), one)

    return let(F.length(line), lambda n: F.when(n >= min_characters, around(n)).otherwise(F.array().cast("array<bigint>")))


def _prefix_hashes(line: Column, use) -> Column:
    """``use`` of a function from place to the hash of the characters before it, for one line."""
    blocks = F.transform(
        F.sequence(F.lit(0), (F.length(line) / _BLOCK).cast("int")), lambda j: F.substr(line, j * _BLOCK + 1, F.lit(_BLOCK))
    )

    def chained(b: Column) -> Column:
        begin = F.array(F.lit(0).cast("bigint"))
        chain = F.aggregate(b, begin, lambda c, x: F.concat(c, F.array(F.xxhash64(F.element_at(c, -1), x))))

        def hash_at(c: Column):
            block = lambda i: (i / _BLOCK).cast("int")
            return lambda i: F.xxhash64(F.get(c, block(i)), F.substr(F.get(b, block(i)), F.lit(1), i % _BLOCK))

        return let(chain, lambda c: use(hash_at(c)))

    return let(blocks, chained)


def neighbourhood(line: Column, i: Column, around: Column) -> Column:
    """Hashed keys of all (P, S) whose place lies in one quarter; ``i`` and ``around`` as in ``_surroundings``."""

    def middle(n: Column) -> Column:
        head, tail = _ends(n, i)
        return F.substr(line, head + 1, n - head - tail)

    def keys(n: Column, before, after) -> Column:
        """``after`` counts from the end of the quarter."""
        whole = F.transform(F.sequence(F.lit(0), n), lambda k: F.xxhash64(around, k, before(k), after(n - k)))
        less = F.transform(F.sequence(F.lit(0), n), lambda k: F.xxhash64(around, k, before(k), after(n - k - 1)))
        return F.concat(whole, F.slice(less, F.lit(1), n))

    def opened(m: Column) -> Column:
        reverse = lambda before: _prefix_hashes(F.reverse(m), lambda after: keys(F.length(m), before, after))
        return _prefix_hashes(m, reverse)

    return let(let(F.length(line), middle), opened)


def _numbered_lines(text: Column) -> Column:
    """(number from 0, line) of the lines with a word."""
    every = F.transform(F.split(text_of(text), "\n"), lambda line, i: F.struct(i.alias("no"), line.alias("line")))
    return F.filter(every, lambda x: F.btrim(x["line"], F.lit(SPACE_CHARACTERS)) != "")


def _named(line: Column) -> list[Column]:
    """Two 64-bit hashes stand for a line."""
    return [F.xxhash64(line).alias("h"), F.xxhash64(F.lit(1), line).alias("g")]


def kept_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_characters: int = MIN_CHARACTERS) -> DataFrame:
    """(``doc_id``, ``kept``: numbers and hashes of lines) of every id that keeps a line.

    A line goes if an equal line, or one within one edit (a character inserted, deleted or
    replaced), stands earlier, by id and then by number; null ids come last. Lines under
    ``min_characters`` go only for equal ones. Lines without a word are not looked at.
    """
    narrow = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    lines = narrow.select(
        F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), F.inline(_numbered_lines(F.col("text")))
    )
    keys = _surroundings(F.col("line"), min_characters).alias("keys")
    hashed = lines.select(*_named(F.col("line")), F.struct("doc", "no").alias("at"), keys)
    distinct = materialize(hashed.groupBy("h", "g").agg(F.min("at").alias("at"), F.any_value("keys").alias("keys")))

    quarters = distinct.select("h", "g", F.posexplode("keys").alias("i", "around")).where("around IS NOT NULL")
    several = quarters.groupBy("around").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("around")
    found = F.collect_list(F.struct("i", "around")).alias("found")  # eight at most
    near = materialize(quarters.join(several, "around").groupBy("h", "g").agg(found))
    chosen = broadcast_checked(near.select("h", "g"))
    texts = lines.select(*_named(F.col("line")), "line").join(chosen, ["h", "g"], "left_semi")
    texts = texts.groupBy("h", "g").agg(F.any_value("line").alias("line"))
    placed = materialize(texts.join(distinct.select("h", "g", "at"), ["h", "g"]).join(near, ["h", "g"]))

    opened = placed.select("h", "g", "at", "line", F.inline("found"))
    variants = opened.select("h", "g", "at", F.explode(neighbourhood(F.col("line"), F.col("i"), F.col("around"))).alias("key"))
    # A key has few lines, whatever the data, so a window over it is short.
    first = F.min(F.struct("at", "h", "g")).over(Window.partitionBy("key")).alias("first")
    pairs = variants.select("h", "g", "at", first).where("first.at < at").select(
        "h", "g", F.col("first.h").alias("fh"), F.col("first.g").alias("fg")
    ).distinct()
    earlier = placed.select(F.col("h").alias("fh"), F.col("g").alias("fg"), F.col("line").alias("first_line"))
    verified = pairs.join(placed.select("h", "g", "line"), ["h", "g"]).join(earlier, ["fh", "fg"])
    gone = verified.where(F.levenshtein("line", "first_line", 1) >= 0).select("h", "g").distinct()

    stay = distinct.join(broadcast_checked(materialize(gone)), ["h", "g"], "left_anti")
    numbers = F.sort_array(F.collect_list(F.struct(F.col("at.no").alias("no"), "h", "g")))
    kept = stay.groupBy(F.col("at.doc").alias("doc")).agg(numbers.alias("kept"))
    return kept.select(F.when(F.col("doc") != _LAST, F.col("doc")).alias("doc_id"), "kept")


def line_report(docs: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``doc_id``, ``n_lines`` (with a word), ``n_removed`` and ``kept`` (line numbers) of every row.

    Rows of one id hold their lines at the same places: equal rows keep the same lines. Empty and
    null texts have no lines. Other columns are not read.
    """
    kept = kept_lines(docs, key, text, **settings)
    rows = docs.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"),
        F.transform(
            _numbered_lines(F.col(f"`{text}`")),
            lambda x: F.struct(x["no"].alias("no"), *_named(x["line"])),
        ).alias("lines"),
    )
    both = rows.alias("r").join(kept.alias("k"), F.col("r.doc_id").eqNullSafe(F.col("k.doc_id")), "left")
    stays = F.array_intersect("r.lines", F.coalesce("k.kept", F.slice("r.lines", 1, 0)))
    return both.select(
        "r.doc_id", F.size("r.lines").alias("n_lines"), (F.size("r.lines") - F.size(stays)).alias("n_removed"),
        F.transform(stays, lambda x: x["no"]).alias("kept"),
    )


def drop_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``docs`` with removed lines cut out of the text; lines without a word stay, null stays null."""
    kept = kept_lines(docs, key, text, **settings).withColumnRenamed("doc_id", "_kept_id").withColumnRenamed("kept", "_kept")
    both = docs.alias("d").join(kept.alias("k"), F.col(f"d.`{key}`").cast("long").eqNullSafe(F.col("k._kept_id")), "left")

    def stays(line: Column, i: Column) -> Column:
        here = F.struct(i.alias("no"), *_named(line))
        return (F.btrim(line, F.lit(SPACE_CHARACTERS)) == "") | F.coalesce(F.array_contains("k._kept", here), F.lit(False))

    joined = F.array_join(F.filter(F.split(F.col(f"d.`{text}`"), "\n"), stays), "\n")
    return both.select(*[joined.alias(c) if c == text else F.col(f"d.`{c}`") for c in docs.columns])


def lines_sql(min_characters: int = MIN_CHARACTERS) -> str:
    """The report in SQL, ids being unique."""
    words = "[^\\x20\\x09-\\x0D]"
    return f"""
WITH every AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS no
               FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
lines AS (SELECT * FROM every WHERE regexp_matches(line, '{words}')),
firsts AS (SELECT line, min({{'d': doc_id, 'n': no}}) AS place, length(line) AS n FROM lines GROUP BY line),
halves AS (SELECT line, place, m, m // 2 AS c FROM (SELECT line, place, unnest([n, n + 1]) AS m FROM firsts WHERE n >= {min_characters})),
pairs AS (SELECT a.line AS a, b.line AS b, a.m FROM halves a JOIN halves b
          ON a.m = b.m AND left(a.line, a.c) = left(b.line, b.c) AND a.place > b.place
          UNION
          SELECT a.line, b.line, a.m FROM halves a JOIN halves b
          ON a.m = b.m AND right(a.line, a.c) = right(b.line, b.c) AND a.place > b.place),
gone AS (SELECT DISTINCT a FROM pairs
         WHERE abs(length(a) - length(b)) <= 1 AND len(list_filter(range(0, m + 1), lambda i:
               left(a, i) = left(b, i) AND (substr(a, i + 2) = substr(b, i + 2) OR substr(a, i + 1) = substr(b, i + 2)
                                            OR substr(a, i + 2) = substr(b, i + 1)))) > 0),
stay AS (SELECT place.d AS doc_id, place.n AS no FROM firsts WHERE line NOT IN (SELECT a FROM gone)),
counted AS (SELECT doc_id, count(*)::BIGINT AS n FROM lines GROUP BY doc_id),
kept AS (SELECT doc_id, count(*)::BIGINT AS k, string_agg(no::VARCHAR, ',' ORDER BY no) AS kept FROM stay GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_lines, (coalesce(n, 0) - coalesce(k, 0))::BIGINT AS n_removed,
       coalesce(kept, '') AS kept_lines
FROM documents LEFT JOIN counted USING (doc_id) LEFT JOIN kept USING (doc_id)"""
