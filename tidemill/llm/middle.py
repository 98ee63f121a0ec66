"""Fill-in-the-middle rewriting, with cuts found through a learned index from rank to offset.

A task cuts its texts in pieces of bounded size. All token boundaries of a piece form one rising sequence of byte
offsets; straight segments are fitted to it so that no boundary lies further than ``ERROR`` bytes from its segment,
and what each prediction misses is kept as one signed byte. A cut at a rank is then the segment's prediction plus the
stored residual, which is exact.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm import textbytes as tb

#: Largest distance of a boundary from its segment: what a signed byte holds.
ERROR = 127
#: Ranks of a segment before it is halved.
LONGEST = 4096
# The marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_MARK = re.compile(rb"<[PSM]>")


class RankIndex:
    """Rising offsets as straight segments with one residual byte for each rank."""

    def __init__(self, offsets: np.ndarray, error: int = ERROR, longest: int = LONGEST):
        self.residuals = np.zeros(len(offsets), np.int8)
        starts = np.arange(0, len(offsets), longest)
        ends = np.minimum(starts + longest, len(offsets))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(starts):
            lengths = ends - starts
            base, slope = offsets[starts], (offsets[ends - 1] - offsets[starts]) / np.maximum(lengths - 1, 1)
            firsts = np.cumsum(lengths) - lengths
            place = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
            rank = place + np.repeat(starts, lengths)
            missed = offsets[rank] - self._line(np.repeat(base, lengths), np.repeat(slope, lengths), place)
            # A segment of two boundaries goes through both, so halving ends.
            good = np.maximum.reduceat(np.abs(missed), firsts) <= error
            kept = np.repeat(good, lengths)
            self.residuals[rank[kept]] = missed[kept]
            done.append((starts[good], base[good], slope[good]))
            starts, ends = starts[~good], ends[~good]
            middles = (starts + ends) // 2
            starts, ends = np.concatenate([starts, middles]), np.concatenate([middles, ends])
        starts, base, slope = (np.concatenate([d[i] for d in done]) if done else np.zeros(0, np.int64) for i in range(3))
        order = np.argsort(starts)
        self.starts, self.base, self.slope = starts[order], base[order], slope[order]

    @staticmethod
    def _line(base: np.ndarray, slope: np.ndarray, place: np.ndarray) -> np.ndarray:
        return base + np.rint(slope * place).astype(np.int64)

    def offsets_at(self, ranks: np.ndarray) -> np.ndarray:
        """Exact offsets of the given ranks."""
        segment = np.searchsorted(self.starts, ranks, "right") - 1
        return self._line(self.base[segment], self.slope[segment], ranks - self.starts[segment]) + self.residuals[ranks]


def token_boundaries(piece: tb.Piece) -> tuple[np.ndarray, np.ndarray]:
    """Boundaries of all tokens of a piece's texts, start of each text included, and the first rank of each text (one more at the end).

    A token is a word with the white space ahead of it, or white space at the end of a text.
    """
    _, word_ends, bounds = tb.word_spans(piece)
    words = np.diff(bounds)
    last = piece.offsets[:-1].copy()
    last[words > 0] = word_ends[bounds[1:][words > 0] - 1]
    blank = piece.offsets[1:] > last
    first = np.concatenate([[0], np.cumsum(1 + words + blank)])
    out = np.empty(first[-1], np.int64)
    out[first[:-1]] = piece.offsets[:-1]
    out[np.repeat(first[:-1] + 1 - bounds[:-1], words) + np.arange(len(word_ends))] = word_ends
    out[first[1:][blank] - 1] = piece.offsets[1:][blank]
    return out, first


def _rewrite(percent: int, suffix_first: int):
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.stack([batch.column(f"_h{i}").to_numpy() for i in range(1, 5)]) if len(batch) else np.zeros((4, 0), np.int64)
            for piece in tb.pieces(batch.column("_text")):
                rows = slice(piece.first, piece.first + len(piece))
                h1, h2, h3, h4 = hashes[:, rows]
                boundaries, first = token_boundaries(piece)
                index = RankIndex(boundaries)
                n = np.diff(first) - 1
                one, two = h1 % (n + 1), h2 % (n + 1)
                begin = index.offsets_at(first[:-1] + np.minimum(one, two))
                end = index.offsets_at(first[:-1] + np.maximum(one, two))
                points = np.concatenate([[0], np.cumsum((piece.data & 0xC0) != 0x80)])
                forms, outputs = [], []
                for i, (a, b, drawn, spm) in enumerate(zip(begin.tolist(), end.tolist(), ((h3 % 100 < percent) & (n > 0)).tolist(), (h4 % 100 < suffix_first).tolist(), strict=True)):
                    text = piece.text(i)
                    if not drawn or _MARK.search(text):
                        forms.append("plain")
                        outputs.append(text)
                        continue
                    a, b = a - int(piece.offsets[i]), b - int(piece.offsets[i])
                    forms.append("spm" if spm else "psm")
                    outputs.append(b"".join((s, text[b:], p, text[:a], m, text[a:b]) if spm else (p, text[:a], s, text[b:], m, text[a:b])))
                plain = pa.array([f == "plain" for f in forms], pa.bool_())
                none = pa.nulls(len(forms), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id").slice(piece.first, len(piece)), pa.array(n, pa.int64()), pa.array(forms, pa.string()),
                        pc.if_else(plain, none, pa.array(points[begin] - points[piece.offsets[:-1]])),
                        pc.if_else(plain, none, pa.array(points[end] - points[begin])),
                        pa.array(outputs, pa.binary()).cast(pa.string()),
                    ],
                    names=["_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return run


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, percent: int = 50, suffix_first: int = 80) -> DataFrame:
    """Per row: id, n tokens, form (plain, psm or spm), code points of prefix and middle (null if plain) and the output text.

    Two hashes of seed and id choose the cuts among the n + 1 token boundaries, a third takes ``percent`` of the
    documents, and a fourth puts the suffix first in ``suffix_first`` percent of these. A null text counts as empty;
    empty texts and texts that hold one of the marks stay plain. Rows with a null id are hashed as an empty id. Rows
    are judged one by one, so repeated rows give repeated results, and an empty table gives an empty one. Other
    columns are not looked at, whatever their names.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))).cast("binary"), 256)
    shaped = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"), digest.alias("_digest"))
    hashed = shaped.select("_id", "_text", *[F.conv(F.substring("_digest", 8 * i + 1, 8), 16, 10).cast("long").alias(f"_h{i + 1}") for i in range(4)])
    out = hashed.mapInArrow(_rewrite(percent, suffix_first), f"_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return out.withColumnRenamed("_id", id_col)


def restored(form: Column, output: Column) -> Column:
    """The text behind an output: no mark stands in a rewritten text, so the marks cut it into its parts."""
    parts = F.split(output, "<[PSM]>", -1)
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )
