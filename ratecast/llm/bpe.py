"""BPE encoding and decoding through a distinct-word table.

1. Each task cuts its texts into words (runs without ASCII white space, which no token of this
   tokenizer crosses) and turns blocks of documents into a list of distinct words and the documents'
   word codes by position.
2. The blocks' words are shuffled by word part (a hash of the word), a part's words of a block packed into a row:
   every distinct word of the corpus is encoded once, by the tokenizer itself. The ids go back to
   the blocks, packed. A task holds the distinct words of one part at a time; there are
   ``PARTS_PER_PARTITION`` parts for each shuffle partition.
3. A block's codes meet its words' ids by position; a piece table with an entry for each
   id (bounded by the vocabulary) joins ids to pieces for decoding.

The texts are cut twice, once for the words and once for the codes, so that neither texts nor positions
are written in between. A block is named by a digest of its words and codes; both scans have to give the
same blocks, so give a table (not the output of a shuffle): a block that finds no ids raises.

Defined results: a null text is empty, with no tokens; texts of special tokens become those ids, as in the
tokenizers library; repeated rows and null doc_ids are encoded row by row; an empty table gives an
empty result; further columns are ignored.
"""
from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, trimmed, arrow_texts, kind_of

BLOCK_WORDS = 3_000_000       # words of a block of documents, at most (a document is never split)
BLOCK_DISTINCT = 400_000      # distinct words at which a block is closed
PARTS_PER_PARTITION = 4
DIGEST_IDS = 1 << 16          # ids of a document turned into text at a time
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def _codes(view, code_of) -> np.ndarray:
    """Word codes of one text (UTF-8), in pieces of about 1 MB cut at white space."""
    parts, a = [], 0
    while a < len(view):
        b = min(a + (1 << 20), len(view))
        while b < len(view):
            at = _SPACE.search(bytes(view[b:b + 65536]))
            if at:
                b += at.start()
                break
            b = min(b + 65536, len(view))
        words = bytes(view[a:b]).split()
        parts.append(np.fromiter(map(code_of, words), np.int32, len(words)))
        a = b
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)


def _blocks(batches, block_words):
    """Blocks of documents: (name, doc_ids, words per document, codes, words)."""
    ids, counts, codes, seen, total = [], [], [], defaultdict(), 0
    seen.default_factory = seen.__len__

    def close():
        flat = np.concatenate(codes) if codes else np.zeros(0, np.int32)
        order = np.argsort(-np.bincount(flat, minlength=len(seen)), kind="stable")   # frequent words get small codes
        rank = np.empty(len(seen), np.int32)
        rank[order] = np.arange(len(seen), dtype=np.int32)
        listed = list(seen)
        words = [listed[k] for k in order]
        flat = rank[flat] if len(flat) else flat
        name = hashlib.blake2b(b"\n".join(words), digest_size=16)
        name.update(flat.tobytes() + repr(ids).encode())
        return name.hexdigest(), list(ids), np.array(counts, np.int64), flat, words

    for b in batches:
        arr = arrow_texts(b.column("text"))
        off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
        view = memoryview(arr.buffers()[2] or b"")
        for i, doc_id in enumerate(b.column("doc_id").to_pylist()):
            c = _codes(view[off[i]:off[i + 1]], seen.__getitem__)
            ids.append(doc_id), counts.append(len(c)), codes.append(c)
            total += len(c)
            if len(seen) >= BLOCK_DISTINCT or total >= block_words:
                yield close()
                ids.clear(), counts.clear(), codes.clear(), seen.clear()
                total = 0
    if ids:
        yield close()


def _pack(a: np.ndarray) -> bytes:
    """Bytes of an int32 array, byte planes apart, deflated."""
    return zlib.compress(np.ascontiguousarray(a.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _unpack(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(b), np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def word_parts(docs: DataFrame) -> int:
    return PARTS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def block_words(docs: DataFrame, parts: int, most: int = BLOCK_WORDS) -> DataFrame:
    """(part, block, codes, words): of each block and word part the words, sorted and deflated, and their codes."""
    def run(batches):
        for name, _, _, _, words in _blocks(batches, most):
            part = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % parts
            order = sorted(range(len(words)), key=words.__getitem__)
            order = np.array(order, np.int64)[np.argsort(part[order], kind="stable")] if order else np.zeros(0, np.int64)
            cuts = np.flatnonzero(np.diff(part[order], prepend=-1, append=parts))
            rows = [(int(part[order[a]]), name, _pack(order[a:b]), zlib.compress(b"\n".join([words[k] for k in order[a:b].tolist()])))
                    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.string(), pa.binary(), pa.binary()))],
                ["part", "block", "codes", "words"])

    return docs.mapInArrow(trimmed(run), "part int, block string, codes binary, words binary")


def block_codes(docs: DataFrame, most: int = BLOCK_WORDS) -> DataFrame:
    """(block, doc_ids, counts, codes): the documents of a block and their words by position."""
    def run(batches):
        for name, ids, counts, codes, _ in _blocks(batches, most):
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([ids], pa.list_(pa.string())), pa.array([_pack(counts)]),
                 pa.array([_pack(codes)])], ["block", "doc_ids", "counts", "codes"])

    return docs.mapInArrow(trimmed(run), "block string, doc_ids array<string>, counts binary, codes binary")


class _Table:
    """The distinct words of one part and their ids, in arrays that grow by doubling."""

    def __init__(self, tok):
        self.tok, self.code = tok, defaultdict()
        self.code.default_factory = self.code.__len__
        self.lens, self.ids, self.used = np.zeros(16, np.int64), np.zeros(64, np.int64), 0
        self.starts = np.zeros(16, np.int64)

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])

    def look_up(self, words: list[bytes]):
        """(lengths, ids one after another) of the words; those not met before are encoded."""
        had = len(self.code)
        at = np.fromiter(map(self.code.__getitem__, words), np.int64, len(words))
        new = [w.decode("utf-8", "replace") for w, k in zip(words, at.tolist()) if k >= had]
        if new:
            ids = [e.ids for e in self.tok.encode_batch(new, add_special_tokens=False)]
            lens = np.array([len(x) for x in ids], np.int64)
            total = self.used + int(lens.sum())
            self.lens, self.starts = self._room(self.lens, had + len(new)), self._room(self.starts, had + len(new))
            self.ids = self._room(self.ids, total)
            self.lens[had:had + len(new)] = lens
            self.starts[had:had + len(new)] = self.used + np.cumsum(lens) - lens
            self.ids[self.used:total] = [y for x in ids for y in x]
            self.used = total
        return self.lens[at], self.ids[_spread(self.starts[at], self.lens[at])]


def encode_words(words: DataFrame, tokenizer: str) -> DataFrame:
    """(part, block, codes, words) -> (block, codes, lens, ids), packed. The rows of a part come one after another,
    so each distinct word is encoded once and its ids are copied to the blocks that have it."""
    def run(batches):
        tok, part, known = load(tokenizer), None, None
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                if r.part != part:
                    part, known = r.part, _Table(tok)
                lens, ids = known.look_up(zlib.decompress(r.words).split(b"\n"))
                rows.append((r.block, bytes(r.codes), _pack(lens), _pack(ids)))
            yield pd.DataFrame(rows, columns=["block", "codes", "lens", "ids"])

    return words.repartition("part").sortWithinPartitions("part").mapInPandas(
        trimmed(run), "block string, codes binary, lens binary, ids binary")


def _spread(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices starts[i] .. starts[i] + lens[i] - 1 for every i, one after another."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lens), lens)


def _digests(ids: np.ndarray, number: list[str], pieces: list[str]) -> tuple[str, str]:
    """SHA-256 of a document's decimal ids and of its pieces, each joined by a space, ``DIGEST_IDS`` at a time."""
    by_id, by_piece = hashlib.sha256(), hashlib.sha256()
    for a in range(0, len(ids), DIGEST_IDS):
        some, lead = ids[a:a + DIGEST_IDS].tolist(), " " if a else ""
        by_id.update((lead + " ".join(map(number.__getitem__, some))).encode())
        by_piece.update((lead + " ".join(map(pieces.__getitem__, some))).encode())
    return by_id.hexdigest(), by_piece.hexdigest()


def encode(docs: DataFrame, tokenizer: str, with_ids: bool = False, most: int | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by a space), decoded_sha256 (of the decoded text)
    for every row of ``docs``; ``with_ids`` adds ids array<int>. ``most``: words of a block; a task holds one block,
    so with ids the default is a third of the usual."""
    most = most or (BLOCK_WORDS // 3 if with_ids else BLOCK_WORDS)
    table = docs.sparkSession.sparkContext.broadcast(_pieces(tokenizer))      # bounded by the vocabulary
    kind = kind_of(docs, "doc_id")
    small = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    words = encode_words(block_words(small, word_parts(docs), most), tokenizer)

    def join(left, right):
        pieces = table.value
        number = list(map(str, range(len(pieces))))
        codes, part_lens, part_ids = (np.concatenate([_unpack(x) for x in right.column(c).to_pylist()] or [np.zeros(0, np.int64)])
                                      for c in ("codes", "lens", "ids"))
        lens = np.zeros(len(codes), np.int64)
        lens[codes] = part_lens
        starts = np.cumsum(lens) - lens
        flat = np.zeros(len(part_ids), np.int32)
        flat[_spread(starts[codes], part_lens)] = part_ids
        del codes, part_lens, part_ids
        names, digests, found = [], [], []
        for doc_ids, counts, packed in zip(*(left.column(c).to_pylist() for c in ("doc_ids", "counts", "codes"))):
            by_position, at = _unpack(packed), 0
            if len(by_position) and by_position.max() >= len(lens):
                raise RuntimeError("a block of documents has no word ids: the input changed between two scans; write it to a table first")
            for n in _unpack(counts).tolist():
                c = by_position[at:at + n]
                at += n
                ids = flat[_spread(starts[c], lens[c])]
                digests.append(_digests(ids, number, pieces))
                found.append(ids if with_ids else len(ids))
            names += doc_ids
        sizes = np.array([len(x) for x in found] if with_ids else found, np.int64)
        out = {"doc_id": pa.array(names, pa.string()), "n_tokens": pa.array(sizes, pa.int64()),
               "ids_sha256": pa.array([x for x, _ in digests], pa.string()),
               "decoded_sha256": pa.array([y for _, y in digests], pa.string())}
        if with_ids:
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            out["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found or [flat[:0]]), pa.int32()))
        del flat, starts, lens, found, digests
        release()
        return pa.table(out)

    schema = "doc_id string, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    done = (block_codes(small, most).groupBy("block").cogroup(words.groupBy("block")).applyInArrow(join, schema))
    return done.withColumn("doc_id", F.col("doc_id").cast(kind))


def _pieces(tokenizer: str) -> list[str]:
    tok = load(tokenizer)
    return [tok.id_to_token(k) or "" for k in range(tok.get_vocab_size(with_added_tokens=True))]


def piece_table(spark, tokenizer: str) -> DataFrame:
    """(id, piece): a row for each entry of the vocabulary."""
    return spark.createDataFrame(list(enumerate(_pieces(tokenizer))), "id int, piece string")


def decode(encoded: DataFrame, pieces: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, ids array<int>), keys distinct -> (key, text): ids by position are joined to their
    pieces (a table of the vocabulary's size, broadcast) and put together again in order."""
    at = encoded.select(key, F.posexplode_outer("ids").alias("pos", "id"))
    return (at.join(F.broadcast(pieces), "id", "left").groupBy(key)
            .agg(F.sort_array(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "piece")))).alias("p"))
            .select(key, F.array_join(F.col("p.piece"), " ").alias("text")))
