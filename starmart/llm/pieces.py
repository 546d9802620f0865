"""SentencePiece ids of texts: each distinct marked word of a block is segmented once, its ids go back by position."""

from __future__ import annotations

import hashlib
import io
import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm import kernels as K
from starmart.llm import tables

#: Bytes of text, about, whose words share one list.
PACK = 16 << 20
#: Documents decoded at a time: ids and texts of a whole batch of Spark's take too much memory beside each other.
ROWS = 256

_MARK = "▁"
_WORD = re.compile(" +[^ ]*")
_CROSSES = re.compile(f"[^{_MARK}]{_MARK}")


@lru_cache(maxsize=4)
def processor(model: bytes):
    """The library's model. Raises if its pieces could cross marks, or if it changes texts before it cuts them up."""
    import sentencepiece

    found = sentencepiece.SentencePieceProcessor(model_proto=model)
    if any(_CROSSES.search(found.id_to_piece(i)) for i in range(found.get_piece_size())):
        raise ValueError("the model has pieces that go on beyond a whitespace mark")
    probe = " \ufb01  \u00bd\u00a0a\u0301 \u0130\t\u3000\u00e9 "
    if found.normalize(probe) != (" " + probe).replace(" ", _MARK) or found.eos_id() < 0 or found.is_unknown(found.piece_to_id(_MARK)):
        raise ValueError("the model changes texts before it cuts them up, or has no piece for a mark or the end")
    return found


def _words(text: str) -> list[str]:
    """Marked words of a text without their first mark: further marks, then all up to the next. An empty text has none.

    The library puts a mark before the text and takes blanks for marks, and marks for blanks."""
    text = text.replace(_MARK, " ")
    if text.startswith(" ") or "  " in text:
        return [w[1:] for w in _WORD.findall(" " + text)]
    return text.split(" ") if text else []


def _ids(cut, words: list[str]) -> list[list[int]]:
    """Ids of marked words. The library puts the first mark back, except where nothing follows it."""
    return [own if w else [cut.piece_to_id(_MARK)] for w, own in zip(words, cut.encode(words, num_threads=1))]


class _Numbers(dict):
    """Numbers words as they first come."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def _parts(words, parts: int) -> np.ndarray:
    """Where each word is segmented."""
    return np.fromiter((zlib.crc32(w.encode()) % parts for w in words), np.int64, len(words))


def _small(ids: int) -> type:
    return np.uint16 if ids <= 1 << 16 else np.uint32


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents in packs of some size. A pack is named by its place and its content."""
    at = TaskContext.get().partitionId()
    lines, size, count = [], 0, 0

    def pack() -> pa.RecordBatch:
        data = b"\n".join(lines)
        name = f"{at}-{count}-{hashlib.blake2b(data, digest_size=16).hexdigest()}"
        return pa.RecordBatch.from_pydict({"pack": [name], "data": pa.array([zstandard.compress(data)], pa.binary())})

    for batch in batches:
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            text = text.as_py() or ""
            lines.append(json.dumps([doc_id.as_py(), text], ensure_ascii=False).encode())
            size += len(text)
            if size >= PACK or len(lines) >= PACK >> 6:
                yield pack()
                lines, size, count = [], 0, count + 1
    if lines:
        yield pack()


def _documents(data: bytes) -> Iterator[list]:
    """Id and text of the documents of a pack, one at a time."""
    return map(json.loads, io.BytesIO(zstandard.decompress(data)))


def _listed(parts: int):
    """The distinct marked words of each pack, in lists by the hash of the word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack, data in zip(batch["pack"], batch["data"]):
                found = list(dict.fromkeys(w for _, text in _documents(data.as_py()) for w in _words(text)))
                part = _parts(found, parts)
                order = np.argsort(part, kind="stable")
                used, heads = np.unique(part[order], return_index=True)
                lists = [[found[i] for i in own] for own in np.split(order, heads[1:])] if len(used) else []
                words = [zstandard.compress(json.dumps(own, ensure_ascii=False).encode()) for own in lists]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int32()), pa.array([pack.as_py()] * len(used), pa.string()), pa.array(words, pa.binary())],
                    names=["part", "pack", "words"],
                )

    return run


def _segmented(model):
    """Ids of the listed words. All lists with a word come to one task, which segments it when it first sees it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = processor(model.value)
        kind = np.dtype(_small(cut.get_piece_size()))
        number = _Numbers()
        pieces, ends = array(kind.char, [0]), array("q", [1])  # of the words by number, after one entry of none
        for batch in batches:
            out = []
            for data in batch["words"]:
                words = json.loads(zstandard.decompress(data.as_py()))
                had = len(number)
                place = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
                for own in _ids(cut, [words[i] for i in np.flatnonzero(place >= had)]):
                    pieces.extend(own)
                    ends.append(len(pieces))
                bounds = np.frombuffer(ends, np.int64)
                first, last = bounds[place], bounds[place + 1]
                ids = np.frombuffer(pieces, kind)[K.ranges(first, last)]
                del bounds  # what is looked at cannot grow
                out.append(zstandard.compress((last - first).astype(np.uint32).tobytes() + ids.tobytes()))
            yield pa.RecordBatch.from_arrays([batch["pack"], batch["part"], pa.array(out, pa.binary())], names=["pack", "part", "ids"])

    return run


def _joined(parts: int, model):
    """Ids of the documents of a pack, from those of its words."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        cut = processor(model.value)
        kind, end = _small(cut.get_piece_size()), cut.eos_id()
        found = {p.as_py(): ids.as_py() for p, ids in zip(right["part"], right["ids"])}
        docs, bounds, values = [], [0], []
        for data in left["data"]:
            number, places = _Numbers(), []
            for doc_id, text in _documents(data.as_py()):
                docs.append(doc_id)
                places.append(np.fromiter(map(number.__getitem__, _words(text)), np.int32))
            part, count = _parts(number, parts), len(number)
            del number
            order = np.argsort(part, kind="stable")
            sizes, pieces = [np.zeros(0, np.uint32)], []
            for used, words in zip(*np.unique(part, return_counts=True)):
                if used not in found:
                    raise ValueError("documents came in another order when read again: write them to a table first")
                raw = zstandard.decompress(found[used])
                sizes.append(np.frombuffer(raw, np.uint32, words))
                pieces.append(np.frombuffer(raw, kind, offset=4 * words))
            pieces = np.concatenate([*pieces, np.array([end], kind)])
            ends = np.append(np.cumsum(np.concatenate(sizes), dtype=np.int64), len(pieces))
            first, last = np.empty(count + 1, np.int64), np.empty(count + 1, np.int64)
            order = np.append(order, count)  # the end id, as if it were one more word
            first[order], last[order] = np.r_[0, ends[:-1]], ends
            lengths = [int((last[place] - first[place]).sum()) + 1 for place in places]
            value = np.empty(sum(lengths), np.int32)
            at = 0
            for place, length in zip(places, lengths):
                place = np.append(place, count)
                value[at : at + length] = pieces[K.ranges(first[place], last[place])]
                at += length
                bounds.append(bounds[-1] + length)
            values.append(value)
        flat = values[0] if len(values) == 1 else np.concatenate([np.zeros(0, np.int32), *values])
        return pa.table([pa.array(docs, pa.int64()), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat))], names=["doc_id", "ids"])

    return run


def read_model(path: str | None = None) -> bytes:
    """The model file, read where the driver runs; tasks get it from there. Without a path, the public one."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as file:
        return file.read()


def encoded(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id and ids (with the end id) of every row, as the library encodes the whole text.

    Pieces of the model never go on beyond a whitespace mark, so what lies between marks is cut up by itself, whatever
    stands around it. Documents are gathered in packs of about PACK bytes. Each pack lists its distinct marked words;
    the lists are dealt out by a hash of the word, so equal words meet in one task and are segmented once there. The
    ids return to the pack, which looks up each of its words in order. A word is sent once per pack at most, however
    frequent it is. `docs` has to give the same rows in the same order when it is read again, as tables do; packs carry
    a digest of their content, so another order raises.

    Null and empty texts have the end id only. Long texts are a pack of their own. Rows with equal or null ids stand
    for themselves. Empty tables give no rows. Other columns are not looked at. Raises for models whose pieces cross
    marks or that change texts before they cut them up.
    """
    spark = docs.sparkSession
    processor(model)
    sent, parts = spark.sparkContext.broadcast(model), tables.shuffles(spark)
    packs = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .mapInArrow(_packed, "pack string, data binary")
        .repartition(parts, "pack")
    )
    listed = packs.mapInArrow(_listed(parts), "part int, pack string, words binary")
    segmented = listed.repartition(parts, "part").mapInArrow(_segmented(sent), "pack string, part int, ids binary")
    return packs.groupBy("pack").cogroup(segmented.groupBy("pack")).applyInArrow(_joined(parts, sent), "doc_id long, ids array<int>")


def _texts(cut, lists: pa.Array) -> list[str]:
    """What the library makes of each list of ids. It gets them as arrays: a Python number per id takes longer than decoding it."""
    return [cut.decode(ids.values.to_numpy() if ids.is_valid else []) for ids in lists]


def decoded(rows: DataFrame, model: bytes) -> DataFrame:
    """doc_id, ids, and `text`: what the library makes of the ids. Null ids count as none, ids without a piece raise."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = processor(sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                own = batch.slice(at, ROWS)
                texts = pa.array(_texts(cut, own["ids"]), pa.string())
                yield pa.RecordBatch.from_arrays([*own.columns, texts], names=["doc_id", "ids", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")


def digest(rows: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of decoded rows."""
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
