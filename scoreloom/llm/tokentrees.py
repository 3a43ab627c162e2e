"""Token counts that follow edits: a segment tree over runs of pre-tokens for every document.

The tokenizer never joins a character that is no white space with white space after it, so a text
cut at such borders has as many tokens as its parts together; a border within an added token
of the tokenizer's file is none. Leaves are parts of some hundred
characters; inner nodes hold the characters and tokens below them. An edit descends to the
leaves it touches, takes in neighbours where their border is gone, encodes only that region
again and corrects the sums on the paths to the root.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import col, shuffle_partitions
from scoreloom.llm.tokens import Encoder

#: Characters of a leaf at least, where borders allow.
LEAF = 256
#: A leaf this many times the size makes its document's tree be laid out anew.
GROWN = 8
_BORDER = re.compile(r"(?<=\S)(?=\s)")
EDITS = "array<struct<at:int,removed:int,inserted:string>>"
TREE = "chars array<int>, tokens array<int>"


def parts(text: str, size: int, encoder: Encoder) -> list[str]:
    """The text cut at borders into parts of at least ``size`` characters (the last may be shorter)."""
    out, start = [], 0
    while len(text) - start > size:
        border = _BORDER.search(text, start + size)
        while border and encoder.within_added(text, border.start()):
            border = _BORDER.search(text, border.start() + 1)
        if not border:
            break
        out.append(text[start:border.start()])
        start = border.start()
    out.append(text[start:])
    return out


class TokenTree:
    """Heap-ordered sums: node i has children 2i and 2i + 1, leaves start at ``width``."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.chars, self.tokens = chars, tokens
        self.width = len(chars) // 2

    @classmethod
    def over(cls, leaf_chars: list[int], leaf_tokens: list[int]) -> TokenTree:
        width = 1 << max(len(leaf_chars) - 1, 0).bit_length()
        sums = []
        for leaves in (leaf_chars, leaf_tokens):
            level = np.zeros(width, np.int64)
            level[:len(leaves)] = leaves
            levels = [level]
            while len(levels[-1]) > 1:
                levels.append(levels[-1].reshape(-1, 2).sum(axis=1))
            sums.append(np.concatenate([np.zeros(1, np.int64), *levels[::-1]]))
        return cls(*sums)

    @classmethod
    def of(cls, text: str, encoder: Encoder, size: int = LEAF) -> TokenTree:
        cut = parts(text, size, encoder)
        return cls.over([len(p) for p in cut], [encoder.count(p) for p in cut])

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds character ``place`` (the last with any for the end), and where it starts."""
        node, start = 1, 0
        place = min(place, int(self.chars[1]) - 1)
        while node < self.width:
            node *= 2
            if place >= start + self.chars[node]:
                start += int(self.chars[node])
                node += 1
        return node - self.width, start

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        """Set a leaf and add the differences to all nodes above it."""
        node = leaf + self.width
        more, further = chars - int(self.chars[node]), tokens - int(self.tokens[node])
        while node:
            self.chars[node] += more
            self.tokens[node] += further
            node //= 2

    def edit(self, text: str, at: int, removed: int, inserted: str, encoder: Encoder, size: int = LEAF) -> tuple[str, int]:
        """Replace ``removed`` characters from ``at`` by ``inserted``: the new text and the characters encoded again.

        Places beyond the text are drawn back to its end.
        """
        at = min(max(at, 0), len(text))
        end = min(at + max(removed, 0), len(text))
        new = text[:at] + inserted + text[end:]
        if not text:
            self.put(0, len(new), encoder.count(new))
            return new, len(new)
        first, start = self.leaf_at(at)
        last, stop = self.leaf_at(max(end - 1, at))
        stop += int(self.chars[last + self.width])
        shift = len(new) - len(text)

        def border(place: int) -> bool:
            return place in (0, len(new)) or (not new[place - 1].isspace() and new[place].isspace()
                                              and not encoder.within_added(new, place))

        while first and not border(start):
            first -= 1
            start -= int(self.chars[first + self.width])
        while stop < len(text) and not border(stop + shift):
            last += 1
            stop += int(self.chars[last + self.width])
        region = new[start:stop + shift]
        slots = last - first + 1
        cut = parts(region, max(size, -(-len(region) // slots)), encoder)
        cut = cut[:slots - 1] + ["".join(cut[slots - 1:])] if len(cut) > slots else cut
        for i in range(slots):
            part = cut[i] if i < len(cut) else ""
            self.put(first + i, len(part), encoder.count(part) if part else 0)
        if len(region) > GROWN * size * slots:
            self._lay_out(new, encoder, first, start, stop + shift, size)
        return new, len(region)

    def _lay_out(self, text: str, encoder: Encoder, first: int, start: int, stop: int, size: int) -> None:
        """Leaves of the usual size for a region that has grown; other leaves keep their counts."""
        held = [(int(c), int(t)) for c, t in zip(self.chars[self.width:], self.tokens[self.width:])]
        last, place = first, start
        while place < stop:
            place += held[last][0]
            last += 1
        fresh = [(len(p), encoder.count(p)) for p in parts(text[start:stop], size, encoder)]
        leaves = [x for x in held[:first] + fresh + held[last:] if x[0]]
        tree = TokenTree.over([c for c, _ in leaves], [t for _, t in leaves])
        self.chars, self.tokens, self.width = tree.chars, tree.tokens, tree.width


def token_tree(text: Column, tokenizer: str | None = None, size: int = LEAF) -> Column:
    """A struct of the arrays ``chars`` and ``tokens`` of a text's tree; null counts as empty."""
    @F.pandas_udf(TREE)
    def build(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(tokenizer)
        for batch in batches:
            trees = [TokenTree.of(t, encoder, size) for t in batch]
            yield pd.DataFrame({"chars": [t.chars for t in trees], "tokens": [t.tokens for t in trees]})

    return build(F.coalesce(text.cast("string"), F.lit("")))


def edited_tree(text: Column, tree: Column, edits: Column, tokenizer: str | None = None, size: int = LEAF,
                with_text: bool = True) -> Column:
    """The text and tree after an array of edits, applied one after the other.

    A struct of ``edited_text`` (null unless ``with_text``), ``chars``, ``tokens``, ``edited_tokens``,
    ``edited_chars`` and ``reencoded_chars``. A null text is empty, null edits are none; null fields of
    an edit count as 0 or nothing inserted.
    """
    @F.pandas_udf(f"edited_text string, {TREE}, edited_tokens long, edited_chars long, reencoded_chars long")
    def apply(batches: Iterator[tuple[pd.Series, pd.DataFrame, pd.Series]]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(tokenizer)
        for texts, trees, changes in batches:
            rows = []
            for t, chars, tokens, todo in zip(texts, trees["chars"], trees["tokens"], changes):
                now = TokenTree(np.array(chars, np.int64), np.array(tokens, np.int64))
                again = 0
                for e in todo:
                    t, n = now.edit(t, int(e["at"] or 0), int(e["removed"] or 0), e["inserted"] or "", encoder, size)
                    again += n
                rows.append((t if with_text else None, now.chars, now.tokens, int(now.tokens[1]), len(t), again))
            yield pd.DataFrame(rows, columns=["edited_text", "chars", "tokens", "edited_tokens", "edited_chars",
                                              "reencoded_chars"])

    return apply(F.coalesce(text.cast("string"), F.lit("")), tree, F.coalesce(edits, F.array().cast(EDITS)))


def with_trees(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, tree`` of every row: the table that later edits start from."""
    return docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"),
                       token_tree(col(text_col)).alias("tree"))


def apply_edits(trees: DataFrame, edits: DataFrame) -> DataFrame:
    """``doc_id, text, tree, tokens, reencoded_chars`` after ``edits (doc_id, nth, at, removed, inserted)``.

    Edits of a document run in the order of ``nth`` (ties: by place, then by what they do), each on the
    text the one before left. Documents without edits keep their tree; edits of unknown or
    null ids are ignored; rows that share an id all get its edits.
    """
    gathered = edits.where("doc_id is not null").groupBy("doc_id").agg(F.transform(F.sort_array(F.collect_list(
        F.struct("nth", "at", "removed", "inserted"))), lambda e: F.struct(
            e["at"].cast("int").alias("at"), e["removed"].cast("int").alias("removed"),
            e["inserted"].cast("string").alias("inserted"))).alias("edits"))
    both = trees.join(gathered.repartition(shuffle_partitions(trees.sparkSession), "doc_id"), "doc_id", "left")
    after = both.withColumn("e", edited_tree(F.col("text"), F.col("tree"), F.col("edits")))
    return after.select("doc_id", F.when(F.col("edits").isNull(), F.col("text")).otherwise(F.col("e.edited_text")).alias("text"),
                        F.struct("e.chars", "e.tokens").alias("tree"), F.col("e.edited_tokens").alias("tokens"),
                        "e.reencoded_chars")


def edit_of_each(text: Column) -> Column:
    """Three edits that a text itself fixes: words put in at its middle, a cut, and a new head."""
    n = F.length(F.coalesce(text.cast("string"), F.lit("")))
    third = F.substring(text, F.floor(n / 3).cast("int") + 1, F.lit(24))

    def one(at, removed, inserted):
        return F.struct(at.cast("int").alias("at"), removed.cast("int").alias("removed"), inserted.alias("inserted"))

    return F.array(one(F.floor(n / 2), F.lit(0), F.concat(F.lit(" "), F.coalesce(third, F.lit("")))),
                   one(F.floor(n / 4), F.least(F.floor(n / 8), F.lit(60)), F.lit("")),
                   one(F.lit(0), F.least(n, F.lit(5)), F.lit("Edited:")))


def edited_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token counts of every text before and after the edits of ``edit_of_each``.

    Returns ``doc_id, tokens, edited_tokens, edited_chars, reencoded_chars``, one row per input row; null
    and empty texts count as empty. An empty table gives an empty one; further columns are ignored.
    """
    rows = with_trees(docs, id_col, text_col).withColumn("e", edited_tree(
        F.col("text"), F.col("tree"), edit_of_each(F.col("text")), with_text=False))
    return rows.select("doc_id", F.get(F.col("tree.tokens"), F.lit(1)).cast("long").alias("tokens"),
                       "e.edited_tokens", "e.edited_chars", "e.reencoded_chars")
