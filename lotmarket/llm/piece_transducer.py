"""SentencePiece encoding and decoding by a weighted finite-state transducer.

``compile_model`` turns a model file into one machine of three composed parts:

-   the normaliser: one state that reads a character and writes it, a space as the mark ``U+2581``, after a first mark
    for the text's beginning if the model has that;
-   the pieces: from each place of the input an arc for every piece that is read there, writing its id;
-   byte fallback: for a character that no piece has, arcs for its UTF-8 bytes.

Composed with a text, this is a lattice over its places, and the encoding is its shortest path in the tropical
semiring.  For a unigram model an arc weighs its piece's negative score.  A byte-pair model has no such weights: its
encoding is what merging the best-scored neighbours over and over leaves.  For it the machine is composed with a
bigram acceptor: two neighbouring arcs have weight 0 if merging their joined text gives these two pieces, and infinity
otherwise.  Merges never cross a border that stays, so the encoding's neighbours all have weight 0; and the first
merge across a border of any other path would happen between just these two neighbours as well, so that path has an
infinite weight.  The one path of weight 0 is the encoding.  Acceptor weights are worked out when first met and kept.

A text falls into units where no piece can lie across: before a mark that follows another character, and around line
feeds if no piece has them.  Units' paths are kept (``KEPT`` of them, and no longer than a task), so that each frequent word is solved once.

``decode`` is the inverse machine: pieces' text, bytes joined to characters, marks as spaces, without the first one.

Rows are independent: no shuffle, and a lost task is run again.  The machine is as large as the model file and goes to
the tasks as a broadcast.  A long text costs time and memory in proportion.

Nulls and edge cases: a null or empty text has no pieces; repeated rows are encoded alike; an empty table gives an
empty one; the input's columns are kept, but for those with a result column's name, which are replaced.  A text with
U+2581 itself comes back with spaces there, as in the library.
"""

from __future__ import annotations

import itertools
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lotmarket.llm.common import bounded_batches, list_array, text_steps

MARK = "▁"
KEPT = 450_000
#: Acceptor weights that are kept.
KEPT_BIGRAMS = 300_000
#: Bits of a piece's id.
SHIFT = 24
INFINITE = float("inf")


@dataclass
class Machine:
    """The compiled transducer."""

    pieces: dict[str, int]
    scores: list[float]
    bytes_at: list[int]
    texts: list[bytes]
    merges: bool
    first_mark: bool
    paths: dict[str, bytes] = field(default_factory=dict)  # ids as packed 32-bit numbers
    joined: dict[int, bool] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.names = {k: p for p, k in self.pieces.items()}
        self.characters = {p for p in self.pieces if len(p) == 1}
        if not self.characters.issuperset("".join(self.pieces)):
            raise ValueError("a character of a piece is no piece itself")
        across = any(MARK in p.lstrip(MARK) for p in self.pieces)
        line = "" if any("\n" in p for p in self.pieces) else "\n"
        # A small letter before a mark of punctuation that no piece has after a small letter is such a border as well.
        small = "".join(sorted(c for c in self.characters if c.islower()))
        after = {p[i + 1] for p in self.pieces for i in range(len(p) - 1) if p[i].islower()}
        ends = "".join(re.escape(c) for c in sorted(self.characters) if c not in after and not c.isalnum() and c != MARK)
        unit = rf"(?:[^{small}{MARK}{line}]+|[{small}]+(?![{ends}]))*[{small}]*" if small and ends else rf"[^{MARK}{line}]*"
        self.units = re.compile(r"(?s).+" if across else rf"{MARK}*{unit}|\n")
        self.arcs = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"arcs": None, "paths": {}, "joined": {}}

    def forget(self) -> None:
        """Give back the kept paths, as a worker process outlives its tasks; acceptor weights stay, they are few."""
        self.paths.clear()

    def automaton(self) -> ahocorasick.Automaton:
        """All pieces as one automaton, which gives every arc of an input; made on each worker."""
        if self.arcs is None:
            self.arcs = ahocorasick.Automaton()
            for piece, k in self.pieces.items():
                self.arcs.add_word(piece, (len(piece), k))
            self.arcs.make_automaton()
        return self.arcs

    def normalise(self, text: str) -> str:
        text = text.replace(" ", MARK)
        return MARK + text if self.first_mark and text else text

    def stays(self, left: str, right: str) -> bool:
        """Whether merging neighbours of the joined text, best score first and leftmost among equals, gives these two."""
        find, scores = self.pieces.get, self.scores
        parts, border = list(left + right), len(left)
        pairs = [find(a + b) for a, b in itertools.pairwise(parts)]
        ranks = [-INFINITE if k is None else scores[k] for k in pairs]
        while ranks and (best := max(ranks)) > -INFINITE:
            at = ranks.index(best)
            if at == border - 1:
                return False
            border -= at < border
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            for i in (at - 1, at):
                if 0 <= i < len(ranks):
                    k = find(parts[i] + parts[i + 1])
                    ranks[i] = -INFINITE if k is None else scores[k]
        return len(parts) == (2 if left else 1)

    def bigram(self, key: int) -> bool:
        """Whether the acceptor's weight is 0 for two neighbouring arcs: ``key`` is the left one's id and 1 (0 at the
        beginning), shifted by SHIFT bits, and the right one's id."""
        if len(self.joined) > KEPT_BIGRAMS:
            self.joined.clear()
        left, right = (key >> SHIFT) - 1, key & ((1 << SHIFT) - 1)
        ok = self.joined[key] = self.stays("" if left < 0 else self.names[left], self.names[right])
        return ok

    def _merge_path(self, text: str) -> list[int]:
        """The path of weight 0.  At each place at most one last arc has weight 0: that of the prefix's encoding."""
        known, bigram = self.joined.get, self.bigram
        last = [-1] * (len(text) + 1)  # the last arc's part of a key
        last[0] = 0
        ends = [0] * (len(text) + 1)
        for end, (length, k) in self.automaton().iter(text):
            end += 1
            if last[end] >= 0:
                continue
            before = last[end - length]
            if before < 0:
                continue
            ok = known(before | k)
            if bigram(before | k) if ok is None else ok:
                last[end], ends[end] = (k + 1) << SHIFT, length
        path, end = [], len(text)
        while end:
            path.append((last[end] >> SHIFT) - 1)
            end -= ends[end]
        return path[::-1]

    def _score_path(self, text: str) -> list[int]:
        """The path of the least sum of negative scores."""
        cost, last, ends = [0.0] + [INFINITE] * len(text), [0] * (len(text) + 1), [0] * (len(text) + 1)
        for end, (length, k) in self.automaton().iter(text):
            weight = cost[end + 1 - length] - self.scores[k]
            if weight < cost[end + 1]:
                cost[end + 1], last[end + 1], ends[end + 1] = weight, k, length
        path, end = [], len(text)
        while end:
            path.append(last[end])
            end -= ends[end]
        return path[::-1]

    def path(self, unit: str) -> list[int]:
        """The shortest path's output; a character without a piece takes its byte arcs, and no other arc crosses it."""
        solve = self._merge_path if self.merges else self._score_path
        if self.characters.issuperset(unit):
            return solve(unit)
        out: list[int] = []
        for known, part in itertools.groupby(unit, self.characters.__contains__):
            text = "".join(part)
            out += solve(text) if known else [self.bytes_at[b] for b in text.encode()]
        return out

    def _kept(self, unit: str) -> bytes:
        ids = self.paths.get(unit)
        if ids is None:
            if len(self.paths) > KEPT:
                self.paths.clear()
            ids = self.paths[unit] = array("i", self.path(unit)).tobytes()
        return ids

    def packed(self, text: str | None) -> bytes:
        """The text's ids as 32-bit numbers on end."""
        return b"".join(map(self._kept, self.units.findall(self.normalise(text or ""))))  # the last unit is empty

    def encode(self, text: str | None) -> list[int]:
        return array("i", self.packed(text)).tolist()

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.texts.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.first_mark and text.startswith(" ") else text


def compile_model(path: str) -> Machine:
    """The machine of a model file with byte fallback and without a character map of its own."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    norm, trainer, kind = model.normalizer_spec, model.trainer_spec, pb.ModelProto.SentencePiece.Type
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or trainer.treat_whitespace_as_suffix or not trainer.byte_fallback:
        raise ValueError("only models with an identity normaliser and byte fallback are compiled")
    pieces = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kind.NORMAL}
    at = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kind.BYTE}
    texts = [bytes([int(p.piece[3:5], 16)]) if p.type == kind.BYTE else b"" if p.type in (kind.CONTROL, kind.UNKNOWN)
             else p.piece.replace(MARK, " ").encode() for p in model.pieces]
    return Machine(pieces, [p.score for p in model.pieces], [at[f"<0x{b:02X}>"] for b in range(256)], texts,
                   trainer.model_type == pb.TrainerSpec.BPE, norm.add_dummy_prefix)


def encoded(docs: DataFrame, path: str, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with ``pieces`` (ids), ``n_pieces`` and ``round_trip``: decoding gives the text."""
    made = [T.StructField("pieces", T.ArrayType(T.IntegerType())), T.StructField("n_pieces", T.LongType()),
            T.StructField("round_trip", T.BooleanType())]
    keep = [c for c in (docs.columns if carry is None else carry) if c not in {f.name for f in made}]
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(compile_model(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for step in text_steps(batches, text):
            texts = step.column(step.schema.get_field_index(text)).to_pylist()
            packed = [machine.packed(x) for x in texts]
            n = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
            flat = np.frombuffer(b"".join(packed), dtype=np.int32)
            same = [machine.decode(array("i", k).tolist()) == (x or "") for k, x in zip(packed, texts, strict=True)]
            yield pa.RecordBatch.from_arrays([step.column(step.schema.get_field_index(c)) for c in keep] + [list_array(flat, n), pa.array(n), pa.array(same)],
                                             names=[*keep, *(f.name for f in made)])
        machine.forget()

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, T.StructType([docs.schema[c] for c in keep] + made))


def decoded(rows: DataFrame, path: str, pieces: str = "pieces", carry: list[str] | None = None) -> DataFrame:
    """``rows`` (or its columns ``carry``) with ``decoded``, the text of the ids in ``pieces``; null ids give null."""
    keep = [c for c in (rows.columns if carry is None else carry) if c != "decoded"]
    bounded_batches(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(compile_model(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(pieces)).to_pylist()
            texts = pa.array([None if x is None else shared.value.decode(x) for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in keep] + [texts], names=[*keep, "decoded"])

    return rows.select(*dict.fromkeys([*keep, pieces])).mapInArrow(run, T.StructType([rows.schema[c] for c in keep] + [T.StructField("decoded", T.StringType())]))
