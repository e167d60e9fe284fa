"""Best-fit packing by length patterns, fitted with non-negative least squares.

Texts become token ids where they are read; a text with more than ``tokens`` ids is cut there, any other stays whole.
Only the pieces' lengths go on (some 40 bytes a text): they are dealt evenly to blocks of ``BLOCK`` pieces, and each
block is packed by itself:

1. lengths are rounded to a grid of ``GRID`` steps, which gives a histogram;
2. all patterns of up to ``DOCUMENTS`` lengths that fill a sequence on this grid are enumerated;
3. non-negative least squares finds how often each pattern has to repeat so that all of them together make the
   histogram; a step weighs as much as the tokens it stands for;
4. the repeat counts are rounded down and pieces take their places; a sequence that its real lengths overfill gives
   its smallest pieces back;
5. the rest is packed best fit first by real length, longest first, into the room left and into new sequences.

At most one sequence a block stays badly filled, however large the table is.

Defined results: a NULL text is empty and gives only the closing id; a NULL id stays NULL; repeated rows are packed as
often as they come; an empty table gives no rows; other columns are ignored. Sequence numbers are unique, not dense.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quoteloom.llm.common import small_batches
from quoteloom.session import stage

GRID, DOCUMENTS = 64, 6
# Pieces that are packed together; fewer when their ids come along.
BLOCK, BLOCK_WITH_IDS = 100_000, 16_384
# A task numbers its sequences from its partition's number shifted by so many bits.
SEQUENCE_BITS = 36
# Entries of each of the two caches in a Python worker.
CACHE_WORDS = 500_000


# Characters for which the fast way below gives what the library gives: visible ones below U+0180, without the one
# whose lower case has two.
_PLAIN = re.compile("[\x21-\x7e\xa1-\u012f\u0131-\u017f]+")


def _runs() -> re.Pattern:
    """Pieces of a plain word in lower case: contractions, runs of letters, single digits, runs of the rest."""
    kinds: dict[str, list[str]] = {"L": [], "N": []}
    for c in map(chr, range(0x21, 0x250)):
        kinds.get(unicodedata.category(c)[0], []).append(c)
    letters, digits = "".join(kinds["L"]), "".join(kinds["N"])
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^{letters}{digits}]+")


def byte_characters() -> dict[int, str]:
    """The character that byte-level vocabularies write for each byte: itself if it can be seen, else one from U+0100 on."""
    seen = [k for k in range(256) if 0x21 <= k <= 0x7E or 0xA1 <= k <= 0xFF and k != 0xAD]
    hidden = sorted(set(range(256)).difference(seen))
    return {k: chr(k) for k in seen} | {k: chr(256 + n) for n, k in enumerate(hidden)}


class WordEncoder:
    """Ids of a ``tokenizers`` file that treats blanks as nothing but ends of words, with caches.

    Texts are cut at ASCII blanks, tabs and line breaks only, and each word's ids are kept. A new word of plain Latin
    characters is cut into its runs as the file's pattern says, whose ids come from the file's own merge model; any
    other word goes to the library as it is. Both give the ids of the whole text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge, self.find, self.shown = self.tokenizer.model.tokenize, _runs().findall, byte_characters()
        self.words: dict[str, bytes] = {"": b""}
        self.runs: dict[str, bytes] = {}

    def _run(self, run: str) -> bytes:
        shown = run if run.isascii() else run.encode().decode("latin-1").translate(self.shown)
        found = array("I", [t.id for t in self.merge(shown)]).tobytes()
        if len(self.runs) >= CACHE_WORDS:
            self.runs.clear()
        self.runs[run] = found
        return found

    def _word(self, word: str) -> bytes:
        if _PLAIN.fullmatch(word) and "<|" not in word:
            runs = self.runs
            found = b"".join([runs[r] if r in runs else self._run(r) for r in self.find(word.lower())])
        else:
            found = array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        if len(self.words) >= CACHE_WORDS:
            self.words = {"": b""}
        if len(word) < 64:
            self.words[word] = found
        return found

    def ids(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        get, new = self.words.get, self._word
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return b"".join([new(w) if (found := get(w)) is None else found for w in words])


def encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker. It hangs on an imported module, which lives from task to task."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_quoteloom_encoders", {})
    if path not in kept:
        kept[path] = WordEncoder(path)
    return kept[path]


def patterns(steps: np.ndarray, total: int, most: int) -> list[tuple[int, ...]]:
    """All ascending tuples of up to ``most`` of the given steps whose sum is ``total``."""
    known = np.unique(steps).tolist()
    has, out = set(known), []

    def extend(head: tuple[int, ...], first: int, left: int, places: int) -> None:
        if left in has and left >= (head[-1] if head else 1):
            out.append((*head, left))
        if places == 1:
            return
        for k in range(first, len(known)):
            if known[k] * 2 > left:
                break
            extend((*head, known[k]), k, left - known[k], places - 1)

    extend((), 0, total, most)
    return out


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """``x >= 0`` with the least ``|a x - b|``, by the active-set method; at most one nonzero for each row of ``a``."""
    n = a.shape[1]
    x, passive = np.zeros(n), np.zeros(n, dtype=bool)
    small = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0.0)))
    for _ in range(rounds):
        gradient = a.T @ (b - a @ x)
        gradient[passive] = -np.inf
        best = int(gradient.argmax()) if n else 0
        if not n or gradient[best] <= small:
            break
        passive[best] = True
        while True:
            inside = np.flatnonzero(passive)
            try_x = np.linalg.lstsq(a[:, inside], b, rcond=None)[0]
            if (try_x > 1e-12).all():
                x[:] = 0
                x[inside] = try_x
                break
            low = inside[try_x <= 1e-12]
            old, new = x[low], try_x[try_x <= 1e-12]
            step = float((old / np.maximum(old - new, 1e-300)).min())
            x[inside] += step * (try_x - x[inside])
            gone = inside[x[inside] <= 1e-12]
            if not len(gone):
                gone = low[:1]
            x[gone] = 0
            passive[gone] = False
            if best in gone and step <= 0:
                break
    return x


def pack_lengths(lengths: np.ndarray, tokens: int, grid: int = GRID, most: int = DOCUMENTS) -> tuple[np.ndarray, np.ndarray]:
    """``(sequence, offset)`` of each length; sequences are numbered from 0."""
    lengths = np.asarray(lengths, dtype=np.int64)
    sequence = np.full(len(lengths), -1, dtype=np.int64)
    full = np.flatnonzero(lengths == tokens)
    sequence[full] = np.arange(len(full))
    n_sequences = len(full)

    rest = np.flatnonzero(lengths < tokens)
    step = np.clip((lengths[rest] * grid + tokens // 2) // tokens, 1, grid)
    by_step = rest[np.argsort(step, kind="stable")]
    counts = np.bincount(step, minlength=grid + 1)
    starts = np.concatenate([[0], np.cumsum(counts)])
    used = np.zeros(grid + 1, dtype=np.int64)
    table = patterns(step, grid, most)
    if table:
        a = np.zeros((grid, len(table)))
        for k, pattern in enumerate(table):
            for part in pattern:
                a[part - 1, k] += part
        repeats = nonnegative_least_squares(a, counts[1:] * np.arange(1.0, grid + 1))
        for k in np.argsort(-repeats, kind="stable"):
            times = int(repeats[k] + 1e-6)
            if not times:
                break
            parts, need = np.unique(np.array(table[k]), return_counts=True)
            times = int(min(times, ((counts[parts] - used[parts]) // need).min()))
            for part, number in zip(parts.tolist(), need.tolist()):
                at = starts[part] + used[part]
                sequence[by_step[at : at + times * number]] = np.tile(np.arange(n_sequences, n_sequences + times), number)
                used[part] += times * number
            n_sequences += times

    def rooms() -> np.ndarray:
        placed = sequence >= 0
        return tokens - np.bincount(sequence[placed], weights=lengths[placed], minlength=n_sequences).astype(np.int64)

    room = rooms()
    while (room < 0).any():
        inside = np.flatnonzero((sequence >= 0) & (room[sequence] < 0))
        inside = inside[np.lexsort((inside, lengths[inside], sequence[inside]))]
        sequence[inside[np.unique(sequence[inside], return_index=True)[1]]] = -1
        room = rooms()

    # Best fit: rooms[r] has the sequences with r free tokens, and bit r of ``open_rooms`` says that there are some.
    free: dict[int, list[int]] = {}
    for k, r in enumerate(room.tolist()):
        if r:
            free.setdefault(r, []).append(k)
    open_rooms = sum(1 << r for r in free)
    left = np.flatnonzero(sequence < 0)
    left = left[np.lexsort((left, -lengths[left]))]
    for item, size in zip(left.tolist(), lengths[left].tolist()):
        fitting = open_rooms >> size
        if fitting:
            r = size + (fitting & -fitting).bit_length() - 1
            at = free[r].pop()
            if not free[r]:
                del free[r]
                open_rooms ^= 1 << r
        else:
            r, at = tokens, n_sequences
            n_sequences += 1
        sequence[item] = at
        if r > size:
            if r - size not in free:
                free[r - size] = []
                open_rooms |= 1 << (r - size)
            free[r - size].append(at)

    order = np.argsort(sequence, kind="stable")
    before = np.cumsum(lengths[order]) - lengths[order]
    heads = np.concatenate([[True], sequence[order][1:] != sequence[order][:-1]]) if len(order) else np.zeros(0, bool)
    offset = np.empty(len(lengths), dtype=np.int64)
    offset[order] = before - before[heads][np.cumsum(heads) - 1]
    return sequence, offset


def pieces_of(df: DataFrame, tokenizer_path: str, tokens: int, closing_id: int, with_ids: bool, id_col: str, text_col: str) -> DataFrame:
    """One row per piece: id, number, start, length, checksum of its ids and, on demand, the ids."""
    end = np.array([closing_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(tokenizer_path)
        for batch in batches:
            at, rows = [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                ids = codec.ids(text) + end
                for piece, start in enumerate(range(0, len(ids), 4 * tokens)):
                    part = ids[start : start + 4 * tokens]
                    at.append(k)
                    rows.append((piece, start // 4, len(part) // 4, zlib.crc32(part), part))
            columns = list(zip(*rows)) if rows else [[]] * 5
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids
            arrays = [batch.column(0).take(pa.array(at, pa.int64()))] + [pa.array(list(c), k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(arrays)])

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return df.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")).mapInArrow(run, schema)


def pack_by_patterns(
    df: DataFrame,
    tokenizer_path: str,
    tokens: int = 4096,
    closing_id: int = 1,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece with its ``sequence_id`` and its ``offset`` there; ``with_ids`` adds column ``ids``."""
    if tokens < 2:
        raise ValueError("tokens must be at least 2")
    small_batches(df)
    pieces = stage(pieces_of(df, tokenizer_path, tokens, closing_id, with_ids, id_col, text_col), "pieces")
    blocks = -(-pieces.count() // (BLOCK_WITH_IDS if with_ids else BLOCK))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if held is None or not held.num_rows:
            return
        sequence, offset = pack_lengths(held["length"].to_numpy(), tokens)
        first = TaskContext.get().partitionId() << SEQUENCE_BITS
        held = held.append_column("sequence_id", pa.array(sequence + first)).append_column("offset", pa.array(offset))
        yield from held.to_batches(max_chunksize=20_000)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return pieces.repartition(max(1, blocks)).mapInArrow(pack, f"{schema}, sequence_id long, offset long")
