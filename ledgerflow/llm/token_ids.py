"""Tokenised corpus as files of directly addressable codes (see ``dac``).

Documents are range-partitioned by id; each task tokenises its range in order and writes files of about
``file_ids`` ids to the shared folder.  A checkpointed manifest (one row per file) fixes which files count,
so a task that ran twice leaves an unread file and nothing else.  The files' places in the whole stream are
running sums over the manifest.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import qcol
from ..session import cut_lineage, scratch_path
from . import dac
from .common import attempt_name, filesystem, rows_of, table, utf8

#: Words whose ids a Python worker remembers at most (half of them, and those used since).
REMEMBERED = 500_000
#: Letters that are one code point in lower case too and whose composed form is themselves: ASCII and the Latin letters up to U+017F.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-įı-ſ"
#: Texts whose runs can be told apart here: those letters, ASCII marks but for ``<``, which may open a special token, and white space.
PLAIN = re.compile(rf"[ \t\n\v\f\r!-;=-~{LETTERS}]*")
#: Runs that the vocabulary's pre-tokeniser makes of such a text in lower case (its pattern, fixed); there all bytes above ASCII are letters'.
RUNS = re.compile(rb"[a-z\x80-\xff]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\s0-9a-z\x80-\xff]+")
_KNOWN: dict[str, "_Words"] = {}


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1 as it is, the others from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in set(shown))}


class _Memory(dict):
    """A function's results by its argument, worked out when first asked for; half of ``REMEMBERED`` and those used since are kept."""

    def __init__(self, make: Callable[[bytes], bytes]):
        self.make, self.old = make, {}

    def __missing__(self, key: bytes) -> bytes:
        got = self.old.get(key)
        if got is None:
            got = self.make(key)
        self[key] = got
        return got

    def renew(self) -> None:
        if len(self) > REMEMBERED // 2:
            self.old = dict(self)
            self.clear()


class _Words:
    """Ids of texts, from remembered ids of their words; kept between tasks of a worker.

    A new word of a plain text is cut into the pre-tokeniser's runs; each goes to the library's model.  A word of
    another text, where not plain itself, goes through the whole library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokeniser = Tokenizer.from_file(path)
        self.model = self.tokeniser.model
        self.letters = _byte_letters()
        self.plain, self.any = _Memory(self._plain), _Memory(self._any)

    def _run(self, run: bytes) -> bytes:
        shown = run.decode() if run.isascii() else "".join(map(self.letters.__getitem__, run))
        return array("I", [x.id for x in self.model.tokenize(shown)]).tobytes()

    def _plain(self, w: bytes) -> bytes:
        runs = (w,) if w.isalpha() else RUNS.findall(w)
        return self._run(w) if len(runs) == 1 else b"".join([self.plain[r] for r in runs])

    def _any(self, w: bytes) -> bytes:
        low = _plain_lower(w)
        if low is not None:
            return self.plain[low]
        return array("I", self.tokeniser.encode_batch_fast([w.decode("utf-8", "replace")], add_special_tokens=False)[0].ids).tobytes()

    def ids(self, data: bytes) -> np.ndarray:
        low = _plain_lower(data)
        memory, words = (self.plain, low.split()) if low is not None else (self.any, (data if b"<" in data else data.lower()).split())
        out = np.frombuffer(b"".join(map(memory.__getitem__, words)), "<u4")
        self.plain.renew()
        self.any.renew()
        return out


def _plain_lower(data: bytes) -> bytes | None:
    """A plain text in lower case; None for other texts."""
    text = data.decode("utf-8", "replace")
    if PLAIN.fullmatch(text):
        return data.lower() if len(text) == len(data) else text.lower().encode()
    return None


def word_tokeniser(path: str):
    """text (UTF-8 bytes) -> ids by the tokenizers library, for lower-case vocabularies that drop white space.

    White space ends every token there, so the ids of a text are those of its words in a row, and a word's those
    of its runs; each is encoded once and remembered.  (Texts with ``<``, which may hold special tokens, keep their case.)
    """
    if path not in _KNOWN:
        _KNOWN[path] = _Words(path)
    return _KNOWN[path].ids


def write_ids(docs: DataFrame, tokeniser: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1,
              file_ids: int = 4_000_000) -> DataFrame:
    """Writes all documents and returns the manifest (start, part, seq, path, n_docs, n_ids); ``start``: ids before the file.

    Order: ascending id, null ids first, equal ids by text hash.  Null texts are empty: the end id alone.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-ids")
    fs, path = filesystem(folder)
    fs.create_dir(path, recursive=True)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = (docs.select(qcol(id_col).cast("long").alias("doc_id"), F.xxhash64(qcol(text_col)).alias("h"), utf8(text_col).alias("t"))
           .repartitionByRange(n, F.col("doc_id").asc_nulls_first(), "h")
           .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "h", "t")
           .select(F.spark_partition_id().alias("part"), "doc_id", "t"))
    arrow = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])

    def run(batches):
        encode = word_tokeniser(tokeniser)
        out_fs, out_dir = filesystem(folder)
        part, seq, names, lens, held, size = 0, 0, [], [], [], 0

        def flush() -> pa.RecordBatch:
            name = f"{out_dir}/{attempt_name('ids', '.dac')}"
            with out_fs.open_output_stream(name) as f:
                f.write(dac.file_bytes(names, lens, np.concatenate(held)))
            return table([(part, seq, name, len(lens), sum(lens))], arrow)

        for batch in batches:
            for part, doc, t in rows_of(batch):
                held.append(np.append(encode(t), np.uint32(end_id)))
                names.append(doc)
                lens.append(len(held[-1]))
                size += lens[-1]
                if size >= file_ids:
                    yield flush()
                    seq, names, lens, held, size = seq + 1, [], [], [], 0
        if lens:
            yield flush()

    made = cut_lineage(src.mapInArrow(run, "part int, seq long, path string, n_docs long, n_ids long"))
    return _places(made).withColumn("folder", F.lit(folder))


def _places(made: DataFrame) -> DataFrame:
    """``start`` of every file: first per part (one row per file), then over parts (one row per part)."""
    parts = made.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (made.join(parts, "part")
            .select((F.col("base") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("start"), "part", "seq", "path", "n_docs", "n_ids"))


def read_ids(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, from the files of the manifest by random access."""
    arrow = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        for batch in batches:
            for start, path, folder in rows_of(batch):
                fs, _ = filesystem(folder)
                with fs.open_input_file(path) as f:
                    file = dac.File(f.read())
                out = []
                for k in range(0, len(file.docs), 64):
                    out += [(doc, start + first, len(ids), zlib.crc32(ids.astype("<u4").tobytes())) for doc, first, ids in file.some_docs(k, k + 64)]
                    if len(out) >= 10_000:
                        yield table(out, arrow)
                        out = []
                yield table(out, arrow)

    n = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (manifest.select("start", "path", "folder").repartition(n, "path")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def token_ids(docs: DataFrame, tokeniser: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1,
              file_ids: int = 4_000_000) -> DataFrame:
    """Writes and reads back: doc_id, start, n_tokens, ids_crc32 per row of ``docs``.

    Rows with equal ids are documents of their own, in the order of their text hashes; a null id is
    returned as null.  An empty table writes no file.  Other columns are ignored, whatever their names.
    """
    return read_ids(write_ids(docs, tokeniser, id_col, text_col, end_id, file_ids))


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
