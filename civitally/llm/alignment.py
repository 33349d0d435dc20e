"""Alignment of two tokenizers: common byte ends cut a text into groups, and overlapping tokens are linked."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path
from sys import getsizeof

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civitally.session import cut_lineage, shared_table

from .registry import query, table
from .rows import small_batches

TOKENIZERS = "/opt/tokenizers"
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
# Fixed value: how the byte-level vocabulary splits a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A pair of ids is one long: the A id times this plus the B id.
SHIFT = 2 ** 32
#: A table of at most this many pairs (24 bytes each) is broadcast; a larger one is joined by shuffle.
BROADCAST_PAIRS = 1_000_000
#: Copies of each pair in that shuffle, so that the rows of a pair all documents hold go to many tasks.
SALTS = 32
#: Groups in the results that a worker keeps for copies of a text that come soon.
_KNOWN_GROUPS = 2_000_000
#: Documents put into one batch of results; characters that end one.
_BATCH, _BATCH_CHARS = 128, 1_000_000
#: Characters of a text whose result is kept, at most, and bytes of all that is kept.
_KNOWN_CHARS, _KNOWN_BYTES = 8_000, 64_000_000
#: A decimal id and the sign behind it take one word of this type, with zero bytes between them.
_WORD, _SIGN_AT = np.dtype("<u8"), 56

Encoder = Callable[[str], list[int]]


def byte_level(json: bytes) -> tuple[Encoder, list[bytes]]:
    """Encoder of space + text by a byte-level vocabulary, and the bytes of every id.

    Its pieces write each byte as a character: printable ones as themselves, the others as the next of those
    from 256 on. Ids follow the order of the merges, so they are the ranks that tiktoken works by, at a
    quarter of the time. A text it gives up on (a million spaces) is encoded by the file's own tokenizer.
    """
    from tiktoken import Encoding
    from tokenizers import Tokenizer

    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(own)]
    byte_of = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(others)}
    tokenizer = Tokenizer.from_str(json.decode())
    tokenizer.encode_special_tokens = True
    special = {token.content for token in tokenizer.get_added_tokens_decoder().values()}
    pieces = [b""] * tokenizer.get_vocab_size()
    for piece, at in tokenizer.get_vocab().items():
        pieces[at] = piece.encode() if piece in special else bytes(byte_of[c] for c in piece)
    ranks = {pieces[at]: at for piece, at in tokenizer.get_vocab().items() if piece not in special}
    ranked = Encoding("byte-level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        try:
            return ranked.encode_ordinary(" " + text)
        except BaseException as error:
            # A panic of the extension is no Exception.
            if type(error).__name__ not in ("PanicException", "ValueError", "RuntimeError"):
                raise
            return tokenizer.encode(" " + text, add_special_tokens=False).ids

    return encode, pieces


def pieces_with_space(model: bytes) -> tuple[Encoder, list[bytes]]:
    """Encoder of the text by a piece vocabulary that adds the space itself, and the bytes of every id."""
    from sentencepiece import SentencePieceProcessor

    processor = SentencePieceProcessor(model_proto=model)
    pieces = []
    for at in range(processor.get_piece_size()):
        piece = processor.id_to_piece(at)
        pieces.append(bytes([int(piece[3:5], 16)]) if processor.is_byte(at) else piece.replace("▁", " ").encode())
    return processor.encode, pieces


def _decimals(size: int) -> np.ndarray:
    """The decimal digits of every id below ``size``, as words."""
    if size > 10 ** 7:
        raise ValueError("a vocabulary has more than ten million ids")
    return np.frombuffer(b"".join(str(at).encode().ljust(_WORD.itemsize, b"\0") for at in range(size)), _WORD)


def _signs(last: np.ndarray, size: int, sign: str) -> np.ndarray:
    """A comma behind each id, and ``sign`` behind those before the cuts ``last``."""
    signs = np.full(size, ord(",") << _SIGN_AT, _WORD)
    signs[last - 1] = ord(sign) << _SIGN_AT
    return signs


class Aligner:
    """Groups and links of one text at a time, from whole arrays of its ids."""

    def __init__(self, a: tuple[Encoder, list[bytes]], b: tuple[Encoder, list[bytes]]):
        (self.encode_a, self.bytes_a), (self.encode_b, self.bytes_b) = a, b
        self.length_a, self.length_b = (np.array([len(t) for t in side]) for side in (self.bytes_a, self.bytes_b))
        self.decimal_a, self.decimal_b = _decimals(len(self.bytes_a)), _decimals(len(self.bytes_b))
        # The result of a text, and the bytes that it is kept in.
        self.known: dict[str | None, tuple] = {}
        self.known_groups = self.known_bytes = 0

    def tokens(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of both sides; none where either side does not give the text's own bytes again."""
        if not text:
            return [], []
        a, b, whole = self.encode_a(text), self.encode_b(text), b" " + text.encode()
        same = all(b"".join(map(table.__getitem__, ids)) == whole for table, ids in ((self.bytes_b, b), (self.bytes_a, a)))
        return (a, b) if same else ([], [])

    def align(self, a: list[int], b: list[int]) -> tuple[list[str], np.ndarray]:
        """Every group in order as ``a1,a2|b1``, and all links as longs."""
        groups, _, links = self._align(a, b)
        return groups.split(";") if groups else [], links

    def _align(self, a: list[int], b: list[int]) -> tuple[str, int, np.ndarray]:
        """The groups joined by semicolons, their number, and the links.

        Both sides' ends are marked on the text's bytes. Each piece between two marks is the overlap of one pair; a mark
        of both sides ends a group.
        """
        if not a:
            return "", 0, np.zeros(0, np.int64)
        ids_a, ids_b = np.array(a, np.int64), np.array(b, np.int64)
        ends_a, ends_b = self.length_a[ids_a].cumsum(), self.length_b[ids_b].cumsum()
        marks = np.zeros(ends_a[-1] + 1, np.int8)
        marks[ends_a] = 1
        marks[ends_b] += 2
        marks = marks[marks > 0]
        of_a, of_b = marks & 1, marks >> 1
        at_a, at_b = of_a.cumsum(dtype=np.int64) - of_a, of_b.cumsum(dtype=np.int64) - of_b
        links = ids_a[at_a] * SHIFT + ids_b[at_b]
        both = marks == 3
        to_a, to_b = at_a[both] + 1, at_b[both] + 1
        size_a, size_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        # An id of A stands behind the ids of B of earlier groups, one of B behind the ids of A up to its own group.
        words = np.empty(len(a) + len(b), _WORD)
        words[np.arange(len(a)) + np.repeat(to_b - size_b, size_a)] = self.decimal_a[ids_a] | _signs(to_a, len(a), "|")
        words[np.arange(len(b)) + np.repeat(to_a, size_b)] = self.decimal_b[ids_b] | _signs(to_b, len(b), ";")
        return words.tobytes().translate(None, b"\0")[:-1].decode(), len(to_a), links

    def measures(self, text: str | None) -> tuple:
        """n_a, n_b, n_groups, n_links, groups, pairs and times of a text; those of recent short texts are kept for copies."""
        kept = self.known.get(text)
        if kept is not None:
            return kept[:-1]
        a, b = self.tokens(text)
        groups, n, links = self._align(a, b)
        found = (len(a), len(b), n, len(links), groups, *np.unique(links, return_counts=True))
        if text is None or len(text) <= _KNOWN_CHARS:
            # A text without tokens has no groups, but takes room.
            room = sum(map(getsizeof, (text, found, *found)))
            self.known[text] = (*found, room)
            self.known_groups, self.known_bytes = self.known_groups + n + 1, self.known_bytes + room
            while self.known and (self.known_groups > _KNOWN_GROUPS or self.known_bytes > _KNOWN_BYTES):
                old = self.known.pop(next(iter(self.known)))
                self.known_groups, self.known_bytes = self.known_groups - old[2] - 1, self.known_bytes - old[-1]
        return found


def with_alignment(docs: DataFrame, text: str = "text", folder: str = TOKENIZERS) -> DataFrame:
    """``docs`` with n_a, n_b, n_groups, n_links, ``groups`` (``a1,a2|b1;a3|b2``), ``pairs`` and ``times``.

    ``pairs`` are the different linked id pairs as longs, rising, ``times`` how often each occurs. Whole texts are
    encoded, whatever their length. Null and empty texts, and those one side cannot give back byte for byte, have
    zeros, an empty text and empty lists. Every row stays, repeated ones too. Columns of ``docs`` with these
    names are replaced. The vocabularies are read by the driver and travel with the function.
    """
    new = T.StructType().add("n_a", "long").add("n_b", "long").add("n_groups", "long").add("n_links", "long").add(
        "groups", "string").add("pairs", T.ArrayType(T.LongType())).add("times", T.ArrayType(T.LongType()))
    kept = [c for c in docs.columns if c not in new.names]
    held = [f"__{k}" for k in range(len(kept))]
    given = small_batches(docs).select(
        *(F.col(f"`{c}`").alias(h) for c, h in zip(kept, held)), F.col(f"`{text}`").alias("__text"))
    schema = T.StructType([*given.select(*held).schema.fields, *new.fields])
    json, model = (Path(folder, name).read_bytes() for name in (BYTE_LEVEL, PIECES))

    def results(batch: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, pa.int64()) for c in list(zip(*rows))[:4]]
        sizes = pa.array(np.cumsum([0, *(len(r[5]) for r in rows)]), pa.int32())
        lists = [pa.ListArray.from_arrays(sizes, pa.array(np.concatenate([r[k] for r in rows]), pa.int64())) for k in (5, 6)]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in range(len(kept))), *columns, pa.array([r[4] for r in rows], pa.string()), *lists],
            names=schema.names)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_level(json), pieces_with_space(model))
        for whole in batches:
            texts, rows, chars = whole.column("__text"), [], 0
            for at in range(whole.num_rows):
                text = texts[at].as_py()
                rows.append(aligner.measures(text))
                chars += len(text or "")
                if len(rows) == _BATCH or chars >= _BATCH_CHARS or at + 1 == whole.num_rows:
                    yield results(whole.slice(at + 1 - len(rows), len(rows)), rows)
                    rows, chars = [], 0

    return given.mapInArrow(align, schema).withColumnsRenamed(dict(zip(held, kept)))


def pair_counts(aligned: DataFrame, pairs: str = "pairs") -> DataFrame:
    """Per linked id pair: ``documents`` that hold it, and ``best``: no pair of its A id is in more.

    Documents hold a pair once, so rows are counted, in the tasks that read them first. An A id has no more pairs than
    B has ids. The counts are written once, with their marks: every file written is a process that the executor starts
    to set its permissions.
    """
    counts = aligned.select(F.explode(pairs).alias("pair")).groupBy("pair").agg(F.count("*").alias("documents"))
    most = F.max("documents").over(Window.partitionBy(F.shiftright("pair", 32)))
    return cut_lineage(counts.select("pair", "documents", (F.col("documents") == most).alias("best")))


def link_measures(aligned: DataFrame, counts: DataFrame, row: str, most: int = BROADCAST_PAIRS) -> DataFrame:
    """Per ``row`` with a link: n_best and count_sum over its links.

    ``counts`` is bounded by the product of the vocabularies and in practice by the pairs that occur. Up to
    ``most`` rows it is broadcast; beyond, rows and pairs meet by shuffle, each pair in SALTS places.
    """
    links = aligned.select(row, F.explode(F.arrays_zip("pairs", "times")).alias("l")).select(row, "l.pairs", "l.times")
    if counts.limit(most + 1).count() <= most:
        met = links.join(F.broadcast(counts), links.pairs == counts.pair)
    else:
        salted = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = links.withColumn("salt", F.pmod(F.xxhash64(row), F.lit(SALTS)).cast("int"))
        met = dealt.join(salted.hint("shuffle_hash"), (dealt.pairs == salted.pair) & (dealt.salt == salted.salt))
    return met.groupBy(row).agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                F.sum(F.col("times") * F.col("documents")).alias("count_sum"))


def align_corpus(docs: DataFrame, text: str = "text", folder: str = TOKENIZERS, most: int = BROADCAST_PAIRS) -> DataFrame:
    """``docs`` without the text, with n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    Texts are encoded once: their different pairs are written to the shared folder and read for the counts and
    for the lookup. Documents without tokens have zeros and an empty digest. Rows are kept apart by number, so
    repeated rows and null ids each have their own result. ``__`` names are reserved.
    """
    new = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    kept = [c for c in docs.columns if c not in new and c != text]
    named = {f"__c{k}": c for k, c in enumerate(kept)}
    numbered = docs.select(*(F.col(f"`{c}`").alias(h) for h, c in named.items()), F.col(f"`{text}`").alias("__whole"),
                           F.monotonically_increasing_id().alias("__row"))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    measured = with_alignment(numbered, "__whole", folder).withColumn("groups_sha256", digest).drop("groups", "__whole")
    aligned = shared_table(measured, "alignment")
    sums = link_measures(aligned, pair_counts(aligned), "__row", most)
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("n_best", "count_sum")}
    out = aligned.drop("pairs", "times").join(sums, "__row", "left").withColumns(zero)
    return out.select(*(F.col(h).alias(c) for h, c in named.items()), *new)


@query()
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment measures of every document."""
    return align_corpus(table(spark, sf_dir, "documents").select("doc_id", "text"))
