"""SentencePiece encoding and decoding over a trie of the distinct marked words.

A normalised text is a row of *marked words* (a run of the mark U+2581, then other
characters). No piece of the vocabulary spans two of them, so the ids of a text
are the ids of its words in order. The distinct words of a batch are sorted and
walked depth-first as a trie: the forward state of every prefix is computed once
and shared by all words that begin with it.

Forward state of a prefix:

* unigram models: the best score and its last piece (Viterbi);
* BPE models: the last piece of the prefix's own encoding. It is unique: it is the
  piece t ending there whose left neighbour u, the state where t begins, keeps apart
  from t (merging u + t gives u, t again). This is Viterbi with allowed/not
  allowed in place of scores, and gives exactly the ids of best-first merging, which
  maximising the scores of a BPE model would not.

Characters outside the vocabulary become their UTF-8 byte pieces. Words met before are
kept in a bounded cache per worker. Nothing is shuffled; memory is bounded by a
slice of documents.

Defined results: null and empty texts have no ids and decode to the empty text;
rows with null or repeated ids are encoded like any others.
"""

from __future__ import annotations

import gc
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm import util as U

MARK = "▁"
KEEP = 800_000
SLICE_ROWS = 4000
WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def _default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class TrieEncoder:
    """Encoder of one vocabulary. ``kind``: ``bpe`` or ``unigram``."""

    def __init__(self, path: str | None = None, kind: str = "bpe"):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path or _default_path())
        if kind not in ("bpe", "unigram"):
            raise ValueError(kind)
        self.kind, self.sp = kind, sp
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.byte_ids = [-1] * 256
        self.raw: list[bytes] = []
        for i in range(sp.vocab_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                b = int(piece[3:5], 16)
                self.byte_ids[b] = i
                self.raw.append(bytes([b]))
            elif sp.is_control(i) or sp.is_unknown(i):
                self.raw.append(b"" if sp.is_control(i) else " ⁇ ".encode())
            else:
                self.ids[piece] = i
                self.scores[piece] = sp.get_score(i)
                self.raw.append(piece.replace(MARK, " ").encode())
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece spans two marked words")
        self.longest = max(map(len, self.ids))
        # pieces of two or more characters as a trie from their last character; "" holds the piece
        self.ends: dict = {}
        for p in self.ids:
            node = self.ends
            if len(p) > 1:
                for c in reversed(p):
                    node = node.setdefault(c, {})
                node[""] = p
        self.plain = sp.normalize(" A  ﬁ \t b ") == f"{MARK}{MARK}A{MARK}{MARK}ﬁ{MARK}\t{MARK}b{MARK}"
        self.apart: dict[str, dict[str, bool]] = {}
        self.pairs = 0
        self.words: dict[str, bytes] = {}
        self.dtype = np.dtype("<i4")
        self.low = min(self.scores.values(), default=0.0) - 10.0

    # --- vocabulary -------------------------------------------------------------

    def merge(self, text: str) -> list[str]:
        """Best-first merging (ties: leftmost) of a short text."""
        s, scores = list(text), self.scores
        while len(s) > 1:
            best, at = None, -1
            for i in range(len(s) - 1):
                x = scores.get(s[i] + s[i + 1])
                if x is not None and (best is None or x > best):
                    best, at = x, i
            if at < 0:
                break
            s[at:at + 2] = [s[at] + s[at + 1]]
        return s

    def _apart(self, u: str, t: str) -> bool:
        """Do u and t stay apart when u + t is encoded? (Cached by the caller's table.)"""
        if self.pairs >= 4 * KEEP:
            self.apart.clear()
            self.pairs = 0
        self.pairs += 1
        got = self.apart.setdefault(u, {})[t] = self.merge(u + t) == ([u, t] if u else [t])
        return got

    def _id_bytes(self, token: str) -> bytes:
        i = self.ids.get(token)
        if i is not None:
            return np.array([i], self.dtype).tobytes()
        return np.array([self.byte_ids[b] if self.byte_ids[b] >= 0 else self.sp.unk_id() for b in token.encode()], self.dtype).tobytes()

    # --- the walk ---------------------------------------------------------------

    def _bpe_states(self, word: str, start: int, last: list[str], _: list[float]) -> None:
        """Appends the last piece of the encoding of word[:i] for every i above ``start``,
        each from the states of shorter prefixes: the longest piece that stays apart."""
        ends, apart, none = self.ends, self.apart, {}
        for i in range(start + 1, len(word) + 1):
            node, j, found = ends, i, []
            while j:
                j -= 1
                node = node.get(word[j])
                if node is None:
                    break
                t = node.get("")
                if t is not None:
                    found.append((last[j], t))
            state = word[i - 1]
            while found:
                u, t = found.pop()
                ok = apart.get(u, none).get(t)
                if ok is None:
                    ok = self._apart(u, t)
                if ok:
                    state = t
                    break
            last.append(state)

    def _best_states(self, word: str, start: int, last: list[str], best: list[float]) -> None:
        """Viterbi: appends the best score and its last piece for every longer prefix."""
        for i in range(start + 1, len(word) + 1):
            top, piece = best[i - 1] + self.low, word[i - 1]
            for n in range(1, min(self.longest, i) + 1):
                t = word[i - n:i]
                x = self.scores.get(t)
                if x is not None and best[i - n] + x > top:
                    top, piece = best[i - n] + x, t
            last.append(piece)
            best.append(top)

    def walk(self, words: Iterable[str]) -> Iterator[tuple[str, list[str]]]:
        """The pieces, last first, of each distinct word, walking the sorted words as a trie."""
        last: list[str] = [""]
        best: list[float] = [0.0]
        before = ""
        states = self._bpe_states if self.kind == "bpe" else self._best_states
        for word in sorted(words):
            same = 0
            for x, y in zip(word, before):  # noqa: B905
                if x != y:
                    break
                same += 1
            del last[same + 1:]
            del best[same + 1:]
            states(word, same, last, best)
            pieces, i = [], len(word)
            while i:
                t = last[i]
                pieces.append(t)
                i -= len(t)
            yield word, pieces
            before = word

    # --- texts ------------------------------------------------------------------

    def marked(self, text: str) -> list[str]:
        """Marked words of a text."""
        if not text:
            return []
        if self.plain:
            if "  " not in text and MARK not in text and text[0] != " ":
                return [MARK + w for w in text.split(" ")]
            return WORDS.findall(MARK + text.replace(" ", MARK))
        return WORDS.findall(self.sp.normalize(text))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        rows = [self.marked(t) for t in texts]
        known = self.words
        new = {w for r in rows for w in r if w not in known}
        if len(known) + len(new) > KEEP:
            known.clear()
            new = {w for r in rows for w in r}
        one: dict[str, bytes] = {}
        on = gc.isenabled()
        gc.disable()  # nothing here makes cycles
        for word, pieces in self.walk(new):
            raw = b""
            for p in pieces:
                got = one.get(p)
                if got is None:
                    got = one[p] = self._id_bytes(p)
                raw = got + raw
            known[word] = raw
        if on:
            gc.enable()
        return [b"".join(map(known.__getitem__, r)) for r in rows]

    def decode(self, ids: bytes) -> str:
        """Text of little-endian 32-bit ids; bytes that aren't UTF-8 become U+FFFD."""
        text = b"".join(map(self.raw.__getitem__, np.frombuffer(ids, self.dtype).tolist())).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


_LOADED: dict[tuple, TrieEncoder] = {}


def encoder(path: str | None = None, kind: str = "bpe") -> TrieEncoder:
    """The worker's encoder of a vocabulary file."""
    if (path, kind) not in _LOADED:
        _LOADED[(path, kind)] = TrieEncoder(path, kind)
    return _LOADED[(path, kind)]


ENCODED = ("doc_id bigint, ids array<int>, n_ids bigint, ids_crc32 bigint, decoded_sha256 string, round_trip boolean")


def encode_texts(docs: DataFrame, path: str | None = None, kind: str = "bpe", id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, ids, n_ids, ids_crc32`` (little-endian 32-bit ids),
    ``decoded_sha256`` of the text decoded from the ids, and whether it is the text again."""
    def run(batches):
        enc = encoder(path, kind)
        for b in batches:
            for at in range(0, b.num_rows, SLICE_ROWS):
                part = b.slice(at, SLICE_ROWS)
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids = enc.encode(texts)
                back = [enc.decode(x) for x in ids]
                lens = np.array([len(x) // 4 for x in ids], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), U.list_column(np.frombuffer(b"".join(ids), np.int32), lens, pa.int32()), pa.array(lens),
                     pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                     pa.array([hashlib.sha256(x.encode()).hexdigest() for x in back]),
                     pa.array([x == y for x, y in zip(back, texts, strict=True)])],
                    names=[c.split()[0] for c in ENCODED.split(", ")])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, ENCODED)


def decode_ids(rows: DataFrame, path: str | None = None, kind: str = "bpe", id_col: str = "doc_id",
               ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` from arrays of ids (null ids: null text)."""
    def run(batches):
        enc = encoder(path, kind)
        for b in batches:
            out = [None if x is None else enc.decode(np.array(x, np.int32).tobytes()) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])

    return (rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
            .mapInArrow(run, "doc_id bigint, text string"))
