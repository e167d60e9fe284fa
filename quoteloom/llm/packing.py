"""Vector bin packing of token sequences.

Texts are turned into token ids inside the tasks and packed where they are read: no shuffle, no driver state.
Whole windows of a long text fill sequences of their own. What is left of each text waits in a pool of bounded
size, from which sequences are filled under three limits at once: tokens, segments and loss-bearing tokens. The
next piece is the one whose demand has the largest dot product with the room that is left (each limit scaled to
1); when no piece fits whole, one is cut to fill the sequence. At the end of a partition the last, unfilled
sequence is cut at powers of two, which need no padding.

Defined results: a NULL text is empty and gives only the closing id; a NULL id stays NULL; repeated rows are
packed as often as they come; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quoteloom.llm.common import small_batches

# Entries of the cache of encoded words in each Python worker.
CACHE_WORDS = 200_000
# Left-over pieces that a task holds before it fills sequences from them.
POOL = 1024
# A task numbers its sequences from its partition's number shifted by so many bits.
SEQUENCE_BITS = 36

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "loss_tokens long, padded_length long"
)


class _Words(dict):
    """Ids (as bytes) of a blank and the word behind it, by word; a word with blanks at its ends is no key."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace() or word[-1].isspace():
            raise ValueError(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        ids = array("I", self.encode(" " + word)).tobytes()
        if len(word) < 64:
            self[word] = ids
        return ids


def added_tokens(json_path: str) -> dict[str, int]:
    """Ids of the added tokens of a ``tokenizers`` file, by their text."""
    with open(json_path, encoding="utf-8") as file:
        tokens = json.load(file).get("added_tokens") or []
    for token in tokens:
        if token["single_word"] or token["lstrip"] or token["rstrip"]:
            raise ValueError(f"added token {token['content']!r} takes in what is beside it")
    return {token["content"]: token["id"] for token in tokens}


class Encoder:
    """Byte-level BPE with a cache by word.

    A token never spans a place where a single blank stands between two other characters, so a text without
    adjoining blanks can be encoded word by word; any other text is encoded as a whole. Both give the ids of the
    plain encoder. A text is cut at the strings in ``added`` first (the longest where several begin), which become
    their ids.
    """

    def __init__(self, ranks_path: str, added: dict[str, int] | None = None):
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.encode = plain.encode_ordinary
        self.words = _Words(self.encode)
        self.added = {text: np.array([k], dtype="<u4") for text, k in (added or {}).items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")

    def ids(self, text: str) -> np.ndarray:
        if not any(a in text for a in self.added):
            return self._plain(text)
        parts = [self.added[p] if k % 2 else self._plain(p) for k, p in enumerate(self.cut.split(text))]
        return np.concatenate(parts)

    def _plain(self, text: str) -> np.ndarray:
        first, *rest = text.split(" ")
        try:
            if not first or first[-1].isspace():
                raise ValueError(first)
            data = array("I", self.encode(first)).tobytes() + b"".join(map(self.words.__getitem__, rest))
        except ValueError:
            data = array("I", self.encode(text)).tobytes()
        return np.frombuffer(data, dtype="<u4")


def encoder(ranks_path: str, added: dict[str, int] | None = None) -> Encoder:
    """The encoder of this Python worker. It hangs on an imported module, which lives from task to task."""
    import tiktoken

    kept = tiktoken.__dict__.setdefault("_quoteloom_encoders", {})
    key = (ranks_path, tuple((added or {}).items()))
    if key not in kept:
        kept[key] = Encoder(ranks_path, added)
    return kept[key]


class Packer:
    """Fills sequences; ``rows`` gets one tuple per placed piece."""

    def __init__(self, first_id: int, tokens: int, segments: int, loss: int, keep_ids: bool):
        self.next_id, self.limits, self.keep_ids = first_id, (tokens, segments, loss), keep_ids
        self.rows: list[tuple] = []
        self.pool: list[tuple] = []  # (doc_id, start, ids, doc_tokens, loss_from)

    def _place(self, pieces: list[tuple], padded: int | None = None) -> None:
        offset, total = 0, sum(len(p[2]) for p in pieces)
        if padded is None:
            padded = total if total & (total - 1) == 0 else self.limits[0]
        for doc_id, start, ids, doc_tokens, loss_from in pieces:
            row = (doc_id, start, len(ids), zlib.crc32(ids.tobytes()), doc_tokens, self.next_id, offset)
            row += (_loss(start, len(ids), loss_from), padded)
            self.rows.append(row + (ids.tobytes(),) if self.keep_ids else row)
            offset += len(ids)
        self.next_id += 1

    def add(self, doc_id, ids: np.ndarray, loss_from: int) -> None:
        tokens, _, loss = self.limits
        window = min(tokens, loss)
        whole = len(ids) // window
        for k in range(whole):
            self._place([(doc_id, k * window, ids[k * window : (k + 1) * window], len(ids), loss_from)])
        if whole * window < len(ids):
            self.pool.append((doc_id, whole * window, ids[whole * window :], len(ids), loss_from))
        if len(self.pool) >= 2 * POOL:
            self.fill(POOL)

    def fill(self, keep: int) -> None:
        """Fills sequences until at most ``keep`` pieces wait."""
        items = self.pool
        size = np.array([len(p[2]) for p in items], dtype=np.float64)
        loss = np.array([_loss(p[1], len(p[2]), p[4]) for p in items], dtype=np.float64)
        waiting = len(items)
        most = self.limits
        while waiting > keep:
            room, rooms, chosen = most[0], most[1], []
            room_loss = most[2]
            while room > 0 and rooms > 0 and waiting:
                fits = (size <= room) & (loss <= room_loss)  # taken pieces have an infinite size
                score = np.where(
                    fits, size * (room / most[0] ** 2) + loss * (room_loss / most[2] ** 2) + rooms / most[1] ** 2, -1.0
                )
                best = int(score.argmax())
                if fits[best]:
                    doc_id, start, ids, doc_tokens, loss_from = items[best]
                    size[best] = np.inf
                    waiting -= 1
                else:
                    best = int(np.where(np.isinf(size), -1.0, size).argmax())
                    doc_id, start, all_ids, doc_tokens, loss_from = items[best]
                    cut = _cut(start, len(all_ids), loss_from, room, room_loss)
                    if not cut:
                        break
                    ids = all_ids[:cut]
                    items[best] = (doc_id, start + cut, all_ids[cut:], doc_tokens, loss_from)
                    size[best] -= cut
                    loss[best] = _loss(start + cut, len(all_ids) - cut, loss_from)
                chosen.append((doc_id, start, ids, doc_tokens, loss_from))
                room -= len(ids)
                rooms -= 1
                room_loss -= _loss(start, len(ids), loss_from)
            if not waiting and keep == 0 and room:
                self._tail(chosen)
            else:
                self._place(chosen)
        self.pool = [p for p, n in zip(items, size) if not np.isinf(n)]

    def _tail(self, pieces: list[tuple]) -> None:
        """Cuts the unfilled last sequence at powers of two."""
        left = sum(len(p[2]) for p in pieces)
        while pieces:
            room, now = 1 << (left.bit_length() - 1), []
            left -= room
            while room:
                doc_id, start, ids, doc_tokens, loss_from = pieces.pop(0)
                now.append((doc_id, start, ids[:room], doc_tokens, loss_from))
                if len(ids) > room:
                    pieces.insert(0, (doc_id, start + room, ids[room:], doc_tokens, loss_from))
                room -= len(now[-1][2])
            self._place(now)


def _loss(start: int, length: int, loss_from: int) -> int:
    return max(0, start + length - max(start, loss_from))


def _cut(start: int, length: int, loss_from: int, room: int, room_loss: int) -> int:
    """Longest head of a piece that fits into the room left."""
    return min(length, room, max(0, loss_from - start) + room_loss)


def pack_documents(
    df: DataFrame,
    ranks_path: str,
    tokens: int = 1024,
    segments: int = 64,
    loss_tokens: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    prompt_col: str | None = None,
    closing_id: int = 0,
    with_ids: bool = False,
    added: dict[str, int] | None = None,
) -> DataFrame:
    """One row per placed piece: where it comes from, its sequence and its place there.

    ``prompt_col`` names a text that comes before ``text_col`` and bears no loss; without it all tokens do.
    ``with_ids`` adds the ids as little-endian 32-bit values in column ``ids``. ``tokens`` must be a power of two.
    ``added`` has the ids of strings that are tokens of their own, see :func:`added_tokens`; without it all is
    ordinary text.
    """
    if tokens & (tokens - 1) or segments < 1:
        raise ValueError("tokens must be a power of two, segments at least 1")
    small_batches(df)
    most_loss = tokens if loss_tokens is None else loss_tokens
    if most_loss < 1:
        raise ValueError("loss_tokens must be at least 1")
    schema = SCHEMA + (", ids binary" if with_ids else "")
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = [pa.int64()] * 9 + ([pa.binary()] if with_ids else [])
    end = np.array([closing_id], dtype="<u4")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(ranks_path, added)
        packer = Packer(TaskContext.get().partitionId() << SEQUENCE_BITS, tokens, segments, most_loss, with_ids)

        def out() -> pa.RecordBatch:
            columns = zip(*packer.rows) if packer.rows else [[]] * len(names)
            arrays = [pa.array(list(c), type=k) for c, k in zip(columns, kinds)]
            packer.rows = []
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            for doc_id, prompt, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.concatenate([codec.ids(text), end])
                head = codec.ids(prompt) if prompt else end[:0]
                packer.add(doc_id, np.concatenate([head, ids]), len(head))
                if len(packer.rows) >= 20_000:
                    yield out()
        packer.fill(0)
        yield out()

    prompt = F.col(prompt_col) if prompt_col else F.lit("")
    rows = df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(prompt, F.lit("")).alias("prompt"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    return rows.mapInArrow(pack, schema)
