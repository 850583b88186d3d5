"""Chat formatting with Spark expressions: turns to one string with a loss mask, and back."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyweave.llm.rows import STRETCH, let, running_totals, text_of


@dataclass(frozen=True)
class Template:
    """Marks of a formatted conversation, and the strings that texts must not contain as they are.

    A block is ``open`` role newline texts ``close``; texts of merged turns stand apart by ``between``.
    """

    open: str = "<|im_start|>"
    close: str = "<|im_end|>\n"
    between: str = "<|turn|>"
    controls: tuple[str, ...] = (
        "<|im_start|>", "<|im_end|>", "<|turn|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>",
        "<</SYS>>",
    )
    learned: tuple[str, ...] = ("assistant",)

    def escapes(self) -> list[tuple[str, str]]:
        """Replacements in the order of escaping: afterwards every backslash starts an escape."""
        return [("\\", "\\0;"), *[(c, f"\\{i};") for i, c in enumerate(self.controls, 1)]]

    def escape(self, text: Column) -> Column:
        return reduce(lambda t, pair: F.replace(t, F.lit(pair[0]), F.lit(pair[1])), self.escapes(), text)

    def unescape(self, text: Column) -> Column:
        return reduce(lambda t, pair: F.replace(t, F.lit(pair[1]), F.lit(pair[0])), reversed(self.escapes()), text)

    def escape_role(self, role: Column) -> Column:
        return F.replace(self.escape(role), F.lit("\n"), F.lit("\\n;"))

    def unescape_role(self, role: Column) -> Column:
        return self.unescape(F.replace(role, F.lit("\\n;"), F.lit("\n")))


TEMPLATE = Template()


def format_conversations(
    rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    template: Template = TEMPLATE,
) -> DataFrame:
    """One row per conversation: ``key``, ``formatted`` and ``mask``.

    Turns are sorted by turn, then role, then text (null turns first), so ties and repeated rows
    have one order; repeated rows stay. A null text or role is empty; null keys are one
    conversation. ``mask`` holds the spans ``start``, ``end`` (characters from 0) of the learned
    texts in ``formatted``. Adjacent turns of one role share a block. Columns of ``rows`` beyond the
    four are not read. A conversation is one string, so its turns meet in one task.
    """
    turns = rows.select(
        F.col(f"`{key}`").alias("k"),
        F.struct(
            F.col(f"`{turn}`").alias("turn"), text_of(F.col(f"`{role}`")).alias("role"), text_of(F.col(f"`{text}`")).alias("text")
        ).alias("t"),
    )
    collected = turns.groupBy("k").agg(F.sort_array(F.collect_list("t")).alias("t"))

    def merged(t: Column) -> Column:
        """Adjacent turns of one role as one block."""
        places = F.sequence(F.lit(0), F.size(t) - 1)
        starts = F.filter(places, lambda i: (i == 0) | (F.get(t, i - 1)["role"] != F.get(t, i)["role"]))
        return let(
            starts,
            lambda s: F.transform(
                s,
                lambda start, i: let(
                    F.slice(t, start + 1, F.coalesce(F.get(s, i + 1), F.size(t)) - start),
                    lambda block: F.struct(
                        block[0]["role"].alias("role"), F.transform(block, lambda x: x["text"]).alias("texts")
                    ),
                ),
            ),
        )

    def pieces(block: Column) -> Column:
        """Strings of a block in order, each with whether it is learned."""
        piece = lambda text, learned: F.struct(text.alias("text"), learned.alias("learned"))
        learned = block["role"].isin(*template.learned)
        head = F.concat(F.lit(template.open), template.escape_role(block["role"]), F.lit("\n"))
        texts = F.transform(
            block["texts"],
            lambda x, i: F.array(
                piece(F.when(i > 0, F.lit(template.between)).otherwise(""), F.lit(False)), piece(template.escape(x), learned)
            ),
        )
        return F.concat(
            F.array(piece(head, F.lit(False))), F.flatten(texts), F.array(piece(F.lit(template.close), F.lit(False)))
        )

    def spans(pieces: Column, ends: Column) -> Column:
        """From where to where each learned piece reaches, given where every piece ends."""
        places = F.filter(F.sequence(F.lit(0), F.size(pieces) - 1), lambda i: F.get(pieces, i)["learned"])
        end = lambda i: F.get(ends, i)
        return F.transform(
            places, lambda i: F.struct((end(i) - F.length(F.get(pieces, i)["text"])).alias("start"), end(i).alias("end"))
        )

    listed = collected.select("k", F.flatten(F.transform(let(F.col("t"), merged), pieces)).alias("p"))
    ends = running_totals(F.transform("p", lambda x: F.length(x["text"])))
    return listed.select(
        F.col("k").alias(key),
        F.array_join(F.transform("p", lambda x: x["text"]), "").alias("formatted"),
        let(ends, lambda e: spans(F.col("p"), e)).alias("mask"),
    )


def read_turns(formatted: Column, template: Template = TEMPLATE) -> Column:
    """The turns (role, text) that a formatted string was made of."""

    def turns(block: Column) -> Column:
        inner = F.substr(block, F.lit(len(template.open) + 1))
        role = template.unescape_role(F.substring_index(inner, "\n", 1))
        texts = F.substr(inner, F.length(F.substring_index(inner, "\n", 1)) + 2)
        each = F.split(texts, f"\\Q{template.between}\\E")
        return F.transform(each, lambda x: F.struct(role.alias("role"), template.unescape(x).alias("text")))

    blocks = F.split(formatted, f"\\Q{template.close}\\E")
    return F.flatten(F.transform(F.slice(blocks, F.lit(1), F.size(blocks) - 1), turns))


def read_learned(formatted: Column, mask: Column, template: Template = TEMPLATE) -> Column:
    """All text under the mask, unescaped, nothing between.

    The string is cut by stretches of spans first: to find a character, Spark counts from the start of
    what it cuts. Escapes are whole in each span, so they are undone in all of them at once.
    """
    firsts = F.filter(F.sequence(F.lit(0), F.size(mask), F.lit(STRETCH)), lambda i: i < F.size(mask))

    def learned(spans: Column) -> Column:
        begin = spans[0]["start"]
        around = F.substr(formatted, begin + 1, F.element_at(spans, -1)["end"] - begin)
        cut = lambda text: F.transform(spans, lambda m: F.substr(text, m["start"] - begin + 1, m["end"] - m["start"]))
        return F.array_join(let(around, cut), "")

    return template.unescape(F.array_join(F.transform(firsts, lambda i: let(F.slice(mask, i + 1, F.lit(STRETCH)), learned)), ""))
