"""Fill-in-middle documents: a text's prefix, suffix and middle in another order.

A text is cut at unit ends (a unit is a word with the blanks before it; blanks that
end the text are a unit too).  Every character has one of four classes, and the texts of
an Arrow batch stand one after the other in wavelet matrices over these classes, one
matrix per ``PIECE`` characters.  The unit ends before a position are the sum of two rank
queries plus the count of the pieces before; the end of the k-th unit is found by
bisection on that count, for all texts of the batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import small_batches
from sheaf.llm.fmindex import Wavelet

PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
SEED = 42
MOVED = 50             # of 100 documents are not plain
SUFFIX_FIRST = 80      # of 100 of those have the suffix first
PIECE = 1 << 20        # characters of one wavelet matrix

#: Classes of characters: solid before solid, solid before a blank or the end, blank before
#: anything, blank that ends the text.
INNER, WORD_END, BLANK, LAST_BLANK = range(4)


class UnitEnds:
    """Unit ends of several texts that stand one after the other."""

    def __init__(self, texts: list[str], piece: int = PIECE):
        self.stop = np.cumsum([len(t) for t in texts], dtype=np.int64)
        self.start = np.r_[0, self.stop[:-1]].astype(np.int64)
        self.piece = piece
        joined = "".join(texts)
        self.matrices: list[Wavelet] = []
        base = [0]
        for lo in range(0, len(joined), piece):
            part = joined[lo:lo + piece + 1]                    # and the character that follows
            codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
            blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
            size = min(piece, len(part))
            follows = np.r_[blank[1:], True][:size]
            blank = blank[:size]
            last = np.zeros(size, bool)
            ends = self.stop[np.searchsorted(self.stop, lo, "right"):np.searchsorted(self.stop, lo + size, "right")]
            last[ends - 1 - lo] = True
            kind = np.where(blank, np.where(last, LAST_BLANK, BLANK), np.where(last | follows, WORD_END, INNER))
            matrix = Wavelet(kind.astype(np.uint8), 2)
            self.matrices.append(matrix)
            base.append(base[-1] + int(self._ends(matrix, np.array([size]))[0]))
        self.base = np.array(base, np.int64)                    # unit ends before each piece

    @staticmethod
    def _ends(matrix: Wavelet, i: np.ndarray) -> np.ndarray:
        """Unit ends among a piece's first ``i`` characters."""
        return sum(matrix.rank(np.full(len(i), kind), i).astype(np.int64) for kind in (WORD_END, LAST_BLANK))

    def before(self, i: np.ndarray) -> np.ndarray:
        """Unit ends among the first ``i`` characters of all."""
        at = i // self.piece
        out = self.base[at]
        for p in np.unique(at[i % self.piece > 0]):
            mine = at == p
            out[mine] += self._ends(self.matrices[p], i[mine] - p * self.piece)
        return out

    def end_of(self, k: np.ndarray) -> np.ndarray:
        """Characters up to the end of unit ``k`` of all (from 1; 0 for 0), by bisection."""
        out = np.zeros(len(k), np.int64)
        at = np.searchsorted(self.base, k, "left") - 1
        for p in np.unique(at[k > 0]):
            mine = np.flatnonzero((at == p) & (k > 0))
            need = k[mine] - self.base[p]
            lo, hi = np.zeros(len(mine), np.int64), np.full(len(mine), self.piece, np.int64)
            hi[:] = min(self.piece, int(self.stop[-1]) - p * self.piece)
            while (lo < hi).any():                              # the smallest count of characters with enough ends
                mid = (lo + hi) // 2
                enough = self._ends(self.matrices[p], mid) >= need
                lo, hi = np.where(enough, lo, mid + 1), np.where(enough, mid, hi)
            out[mine] = lo + p * self.piece
        return out


def cuts(texts: list[str], h1: np.ndarray, h2: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of each text, and the characters before its first and its second cut."""
    ends = UnitEnds(texts, piece)
    first = ends.before(ends.start)
    n = ends.before(ends.stop) - first
    a, b = h1 % (n + 1), h2 % (n + 1)

    def chars(units: np.ndarray) -> np.ndarray:
        return np.where(units > 0, ends.end_of(first + units) - ends.start, 0)

    return n, chars(np.minimum(a, b)), chars(np.maximum(a, b))


def restore(output: Column, form: Column) -> Column:
    """The text that ``fill_in_middle`` made ``output`` of.  A moved text holds no mark, so
    the first place of each mark is the one that was put there."""
    at = lambda mark: F.instr(output, mark)
    between = lambda left, right: F.substring(output, at(left) + len(left), at(right) - at(left) - len(left))
    middle = F.substring(output, at(MIDDLE) + len(MIDDLE), F.length(output))
    return (F.when(form == "psm", F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE)))
            .when(form == "spm", F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX)))
            .otherwise(output))


def fill_in_middle(docs: DataFrame, keep: list[str], seed: int = SEED, moved: int = MOVED, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): kept (a struct of the ``keep`` columns), n
    (units), form (plain, psm, spm), prefix_chars, middle_chars (null if plain), output.

    Forms and cuts come from the SHA-256 of seed and doc_id, so equal ids get equal
    choices and reruns agree; a null id counts as an empty one.  A null text counts as
    empty.  Empty texts and texts that hold a mark stay plain.  Very long texts are cut
    like others, a matrix holds ``PIECE`` characters of them; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    own = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(docs["doc_id"].cast("string"), F.lit(""))), 256)
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("kept"), text.alias("text"), own.alias("own"))
    h = [F.conv(F.substring("own", 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    plain = (F.col("text") == "") | (h[2] % 100 >= moved)
    for mark in MARKS:
        plain = plain | F.contains("text", F.lit(mark))
    form = F.when(plain, "plain").when(h[3] % 100 < suffix_first, "spm").otherwise("psm")
    rows = rows.select("kept", "text", form.alias("form"), h[0].alias("h1"), h[1].alias("h2"))
    made = rows.select("kept", F.lit(0).cast("long").alias("n"), "form", F.col("h1").alias("prefix_chars"),
                       F.col("h2").alias("middle_chars"), F.col("text").alias("output"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, forms = batch.column("text").to_pylist(), batch.column("form").to_pylist()
            n, one, two = cuts(texts, batch.column("h1").to_numpy(), batch.column("h2").to_numpy())
            outputs = []
            for t, f, a, b in zip(texts, forms, one.tolist(), two.tolist(), strict=True):
                outputs.append(t if f == "plain" else f"{PREFIX}{t[:a]}{SUFFIX}{t[b:]}{MIDDLE}{t[a:b]}" if f == "psm"
                               else f"{SUFFIX}{t[b:]}{PREFIX}{t[:a]}{MIDDLE}{t[a:b]}")
            stays = np.array([f == "plain" for f in forms])
            yield pa.RecordBatch.from_arrays(
                [batch.column("kept"), pa.array(n, pa.int64()), batch.column("form"), pa.array(one, pa.int64(), mask=stays),
                 pa.array(two - one, pa.int64(), mask=stays), pa.array(outputs, pa.string())],
                ["kept", "n", "form", "prefix_chars", "middle_chars", "output"])

    return rows.mapInArrow(run, made.schema)
