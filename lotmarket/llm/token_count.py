"""Token counts by rank-synchronous array merging.

A task turns a step of texts into pre-tokens, keeps the distinct ones it hasn't met lately, and encodes these together
as one ragged numpy array: symbols on end, and the sequence each belongs to.  In a round every sequence finds its
lowest-rank adjacent pair and all of them merge at once; sequences without a pair to merge leave the array.  The
number of symbols that survive is the sequence's token count, and a text's count is the sum over its pre-tokens.

Rows are independent: there is no shuffle, a lost task is simply run again, and memory is bounded by the step and the
cache of known pre-tokens (``CACHE_WORDS``).  The driver reads the vocabulary file and broadcasts its bytes, at most
``MAX_VOCABULARY`` of them.

``Vocabulary`` takes files of one kind only and raises ValueError for others: byte-level pairs with an end-of-word mark,
the normaliser and the splitter of ``NORMALIZERS`` and ``SPLITTER``, and special tokens matched as they stand.

The merge is a byte-pair encoding's: of the pairs present the lowest rank first, leftmost first among equals.  All
places of a sequence's lowest-rank pair merge in one round, which is the same, as a pair that holds the new symbol has
a higher rank; ``Vocabulary`` checks that on loading.

Nulls and edge cases: a null text is empty and has 0 tokens and bytes; repeated rows count alike; empty tables give
none.  ``counted`` keeps the input's columns; one that has a result column's name is replaced.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotmarket.llm.common import bounded_batches, text_offsets, text_steps

CACHE_WORDS = 300_000
#: Bytes of a vocabulary file that may be broadcast.
MAX_VOCABULARY = 64 << 20
#: What the fast path assumes of the vocabulary file.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLITTER = {"type": "Split", "behavior": "Removed", "invert": True}
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
#: Up to here Python's and the library's Unicode tables agree; sigma is left out, as its lower case depends on place.
PLAIN = regex.compile(r"[\x00-˿]*")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, all others take the code points from 256 on, in order.
    """
    own = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def check_kind(spec: dict) -> None:
    """Raise ValueError unless the vocabulary is of the kind that is counted here."""
    model = spec["model"]
    if model["type"] != "BPE" or not model.get("end_of_word_suffix"):
        raise ValueError("a byte-pair vocabulary with an end-of-word mark is needed")
    odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
    if odd:
        raise ValueError(f"the model's settings {odd} are not known here")
    if (spec.get("normalizer") or {}).get("normalizers") != NORMALIZERS:
        raise ValueError("the normaliser must be NFC, white space to one blank, lower case")
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    has = lambda step, wanted: all(step.get(k) == v for k, v in wanted.items())
    if len(steps) != 2 or not has(steps[0], SPLITTER) or "Regex" not in steps[0]["pattern"] or not has(steps[1], BYTE_LEVEL):
        raise ValueError("the pre-tokeniser must keep a pattern's matches and turn them to bytes")
    if any(t.get(k) for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("special tokens must be matched as they stand")
    if spec.get("truncation") or spec.get("padding"):
        raise ValueError("the vocabulary cuts or fills texts")


class Vocabulary:
    """Ranked merges over the bytes of a pre-token whose last symbol carries the end-of-word mark."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        check_kind(spec)
        model = spec["model"]
        ids, end = model["vocab"], model["end_of_word_suffix"]
        self.size = len(ids)
        self.inner = np.array([ids[c] for c in byte_symbols()], dtype=np.int64)
        self.last = np.array([ids[c + end] for c in byte_symbols()], dtype=np.int64)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        pairs = np.array([(ids[a], ids[b], ids[a + b]) for a, b in merges], dtype=np.int64)
        key = pairs[:, 0] * self.size + pairs[:, 1]
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], np.arange(len(key))[order], pairs[order, 2]
        self.by_rank = pairs[:, 2]
        born = np.full(self.size, -1, dtype=np.int64)
        born[pairs[:, 2]] = np.arange(len(key))
        if (np.maximum(born[pairs[:, 0]], born[pairs[:, 1]]) >= np.arange(len(key))).any():
            raise ValueError("a merge uses a symbol that a later merge makes")
        self.specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)  # the longest first
        self.split_specials = regex.compile("|".join(map(regex.escape, self.specials))) if self.specials else None
        self.pre = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair; as many as there are merges where it is none."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], len(self.keys))

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Surviving symbols of each word, all words merged in step."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        out = lengths.copy()
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        sym = self.inner[raw]
        ends = np.cumsum(lengths)
        last = ends[lengths > 0] - 1
        sym[last] = self.last[raw[last]]
        seq = np.repeat(np.arange(len(words)), lengths)
        none = len(self.keys)
        while len(sym) > 1:
            rank = np.full(len(sym), none, dtype=np.int64)  # of the pair that begins here
            same = seq[1:] == seq[:-1]
            rank[:-1][same] = self.rank(sym[:-1][same], sym[1:][same])
            starts = np.flatnonzero(np.concatenate([[True], ~same]))
            best = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.concatenate([starts, [len(sym)]]))
            best_of = np.repeat(best, sizes)
            merge = (rank == best_of) & (rank < none)
            at = np.flatnonzero(merge)
            if not len(at):
                break
            # Places side by side overlap (a a a): from each run of them, every second one merges.
            fresh = np.concatenate([[True], np.diff(at) > 1])
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            sym[at] = self.by_rank[rank[at]]
            stay = np.repeat(best < none, sizes)
            stay[at + 1] = False
            np.subtract.at(out, seq[at], 1)
            sym, seq = sym[stay], seq[stay]
        return out


class Counter:
    """Counts texts' tokens; keeps what it knows about pre-tokens between steps."""

    def __init__(self, content: bytes):
        import tokenizers

        self.vocab = Vocabulary(content)
        self.library = tokenizers.Tokenizer.from_buffer(content)
        self.known: dict[str, int] = {}

    def pre_tokens(self, text: str) -> list[str]:
        """Pre-tokens of a text without special tokens, as the vocabulary's normaliser and splitter give them."""
        if PLAIN.fullmatch(text):
            return self.vocab.pre.findall(unicodedata.normalize("NFC", text).lower())
        clean = self.library.normalizer.normalize_str(text)
        return [clean[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(clean)]

    def count(self, texts: list[str | None]) -> np.ndarray:
        split, extra = [], np.zeros(len(texts), dtype=np.int64)
        for i, text in enumerate(texts):
            parts = self.vocab.split_specials.split(text) if text and self.vocab.split_specials else [text or ""]
            extra[i] = len(parts) - 1
            split.append([w for p in parts for w in self.pre_tokens(p)])
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        fresh = list({w for ws in split for w in ws}.difference(self.known))
        if fresh:
            self.known.update(zip(fresh, self.vocab.counts([w.encode() for w in fresh]).tolist(), strict=True))
        get = self.known.__getitem__
        return extra + np.fromiter((sum(map(get, ws)) for ws in split), np.int64, len(split))


def counted(docs: DataFrame, path: str, text: str = "text", limit: int = 2048, carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens)."""
    bounded_batches(docs.sparkSession)
    with open(path, "rb") as f:
        content = f.read()
    if len(content) > MAX_VOCABULARY:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY} bytes")
    check_kind(json.loads(content))  # here already, not only in the tasks
    shared = docs.sparkSession.sparkContext.broadcast(content)
    made = ("n_bytes", "n_tokens")
    keep = [c for c in (docs.columns if carry is None else carry) if c not in (*made, "over_limit")]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(c, T.LongType()) for c in made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for step in text_steps(batches, text):
            column = step.column(step.schema.get_field_index(text))
            tokens = counter.count(column.to_pylist())
            n_bytes = np.diff(text_offsets(column.fill_null("") if column.null_count else column))
            arrays = [step.column(step.schema.get_field_index(c)) for c in keep] + [pa.array(n_bytes), pa.array(tokens)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *made])

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
