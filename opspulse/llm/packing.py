"""Sequence packing: shortest-pack-first over the length histogram.

1. Tokenise each document (one pass, no shuffle) and cut it into full pieces of the
   sequence length and a rest. The pieces are written to the shared folder.
2. The histogram of piece lengths (at most ``size`` rows, whatever the corpus) goes to
   the driver. Lengths are placed longest first, each into the pack that is shortest so
   far (one just opened, if none had room); equal packs are handled together as (pattern, count), so the work depends on the
   number of lengths, not of documents.
3. Each length's pieces are ranked. Ranks are dealt by (length, salt), so that one
   common length does not meet in one task, and shifted by the counts of lower salts.
   A slot (length, range of ranks, first sequence, offset) then says where a piece goes;
   slots are looked up by (length, block of ranks).
   There are at most 3 * size patterns of at most sqrt(2 * size) distinct lengths, which
   bounds the slot table that is broadcast.

Tokenising by words: the tokenizer drops white space and splits between letters, digits
and other characters before it merges, so the ids of a text are those of its words one
after the other. Words are encoded once for each worker and looked up afterwards; words
with characters outside plain Latin letters, digits and punctuation are encoded whole, and
so are texts that spell one of the tokenizer's own special tokens.

Padding: where rests of a few common lengths fill sequences badly (3000 of 4096, say), so
that more than MOST_PADDING of all sequences could be saved, rests are cut at powers of two
down to LEAST_CUT; these fit together, and what is left of each rest is short.

Defined results: null text counts as empty and gives the closing id alone; repeated rows
give repeated pieces; an empty table gives an empty result; only key and text are read.
"""

from __future__ import annotations

import collections
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

SIZE = 4096
END_ID = 2
MOST_PADDING, LEAST_CUT = 0.03, 256
MOST_CHUNKS, MOST_WORDS = 500_000, 700_000  # entries kept by a worker

_PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ0-9!-&(-/:-@\[-`{-~]+")
_SPLIT = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]|[!-&(-/:-@\[-`{-~]+")
_MARKS = frozenset(".,;:!?")
_ODD = re.compile("[\x1c-\x1f]")  # white space to str.split, but not to the tokenizer


class WordEncoder:
    """Texts -> little-endian unsigned 32-bit ids, by looking up words already encoded."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special) if special else r"(?!)")
        vocab = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocab.values()) + 1, bool)  # ids that end a word
        self.closes[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def together(self, words: list[str]) -> list[bytes]:
        """Ids of words that the tokenizer does not split: encoded as one text, cut where a word ends."""
        if not words:
            return []
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = (4 * np.flatnonzero(self.closes[ids]) + 4).tolist()
        if len(ends) != len(words):
            return self.whole(words)
        data = ids.tobytes()
        return [data[i:j] for i, j in zip([0, *ends], ends, strict=False)]

    def learn(self, missing: set[str]) -> None:
        if len(self.chunks) > MOST_CHUNKS:
            self.chunks.clear()
        if len(self.words) > MOST_WORDS:
            self.words.clear()
        words, split, odd = self.words, {}, []
        for c in missing:
            stem = c[:-1]
            if c.isascii() and c.isalpha():
                split[c] = (c.lower(),)
            elif c[-1] in _MARKS and stem.isascii() and stem.isalpha():
                split[c] = (stem.lower(), c[-1])
            elif _PLAIN.fullmatch(c):
                split[c] = (c.lower(),) if c.isalpha() else _SPLIT.findall(c.lower())
            else:
                odd.append(c)
        new = list({w for parts in split.values() for w in parts if w not in words})
        words.update(zip(new, self.together(new), strict=True))
        self.chunks.update((c, words[p[0]] if len(p) == 1 else b"".join([words[w] for w in p])) for c, p in split.items())
        self.chunks.update(zip(odd, self.whole(odd), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [None if _ODD.search(t) or self.special.search(t) else t.split() for t in texts]
        known = self.chunks
        used = set().union(*[s for s in split if s])
        missing = used.difference(known)
        if missing:
            # an overflow empties the table, so the other words of these texts are learnt again
            self.learn(used if len(known) > MOST_CHUNKS else missing)
        return [
            self.whole([t])[0] if s is None else b"".join([known[c] for c in s]) for t, s in zip(texts, split, strict=True)
        ]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def cuts(n: int, size: int, least_cut: int | None = None) -> list[int]:
    """Where the pieces of n ids end: at multiples of size; with least_cut also where powers of two come off the rest."""
    ends = list(range(size, n + 1, size))
    at, step = n - n % size, 1 << (size - 1).bit_length()
    while least_cut and step > least_cut:
        step //= 2
        if n - at >= step:
            at += step
            ends.append(at)
    return ends if n == (ends[-1] if ends else 0) else [*ends, n]


def tokenized_pieces(
    docs: DataFrame, key: str = "doc_id", text_col: str = "text", size: int = SIZE, tokenizer: str | None = None,
    end_id: int = END_ID, keep_ids: bool = True, least_cut: int | None = None,
) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, ids): each document's ids and end_id, cut at multiples of size.

    With least_cut, the rest is cut further, at powers of two down to that length.
    """
    path = tokenizer or default_tokenizer()
    kind = docs.schema[key].dataType.simpleString()
    closing = end_id.to_bytes(4, "little")

    def work(batches):
        enc = encoder(path)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                keys, out, texts = [], [], batch.column(1).slice(i, 256).to_pylist()
                for j, ids in enumerate(enc.encode([t or "" for t in texts])):
                    ids += closing
                    ends = cuts(len(ids) // 4, size, least_cut)
                    for a, b in zip([0, *ends], ends, strict=False):
                        a, piece = 4 * a, ids[4 * a : 4 * b]
                        keys.append(i + j)
                        out.append((a // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4, piece if keep_ids else None))
                cols = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), [pa.int64()] * 4 + [pa.binary()], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(keys)), *cols], [key, "start", "length", "ids_crc32", "doc_tokens", "ids"]
                )

    picked = docs.select(F.col(f"`{key}`"), F.col(f"`{text_col}`").cast("string"))
    return picked.mapInArrow(
        work, f"`{key}` {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ids binary"
    )


def pack_histogram(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Length -> count, to [(packs, ((length, times), ...))]: shortest pack first, lengths from the longest."""
    open_packs: list[list[tuple[int, tuple]]] = [[] for _ in range(size + 1)]  # by free space
    top = 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            while top and not open_packs[top]:
                top -= 1
            if top < length:  # no open pack has room
                each = size // length  # shortest first: the next piece goes into the pack just opened
                for n, times in ((left // each, each), (1, left % each)):
                    if n and times:
                        free = size - length * times
                        open_packs[free].append((n, ((length, times),)))
                        top = max(top, free)
                break
            n, pattern = open_packs[top].pop()
            if n > left:
                open_packs[top].append((n - left, pattern))
                n = left
            last, times = pattern[-1]
            pattern = (*pattern[:-1], (last, times + 1)) if last == length else (*pattern, (length, 1))
            open_packs[top - length].append((n, pattern))
            left -= n
    return [p for packs in open_packs for p in packs]


def slots(patterns: list, size: int = SIZE) -> list[tuple[int, int, int, int, int, int]]:
    """(length, rank_from, rank_to, first_sequence, offset, times) for each length of each pattern."""
    out, used, sequence = [], {}, 0
    for n, pattern in patterns:
        offset = 0
        for length, times in pattern:
            first = used.get(length, 0)
            used[length] = first + n * times
            out.append((length, first, used[length], sequence, offset, times))
            offset += length * times
        sequence += n
    return out


def slot_blocks(rows: list, counts: dict[int, int]) -> tuple[list[tuple[int, int]], list[tuple]]:
    """(length, width) and slots by (length, rank // width, ...), so that a rank meets few slots.

    A length's ranks are cut into about as many blocks as it has slots, so blocks at most double the table.
    """
    many = collections.Counter(r[0] for r in rows)
    widths = {n: max(1, -(-counts[n] // many[n])) for n in many}
    placed = []
    for n, first, last, *rest in rows:
        placed += [(n, b, first, last, *rest) for b in range(first // widths[n], (last - 1) // widths[n] + 1)]
    return list(widths.items()), placed


def pack(pieces: DataFrame, size: int = SIZE, keys: tuple[str, ...] = ("doc_id", "start")) -> DataFrame:
    """pieces (with length and ids_crc32) + sequence_id, offset. Reads pieces three times: pass a written table."""
    spark = pieces.sparkSession
    salts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(*keys, "ids_crc32"), F.lit(salts)))
    by_salt = salted.groupBy("length", "_salt").count()
    lower = by_salt.withColumn(
        "_before", F.sum("count").over(Window.partitionBy("length").orderBy("_salt")) - F.col("count")
    ).drop("count")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most size rows
    widths, blocks = slot_blocks(slots(pack_histogram(histogram, size), size), histogram)
    width_of = spark.createDataFrame(widths, "length bigint, _width bigint")  # at most size rows
    slot_of = spark.createDataFrame(
        blocks, "length bigint, _block bigint, _from bigint, _to bigint, _sequence bigint, _offset bigint, _times bigint"
    )
    own = Window.partitionBy("length", "_salt").orderBy(*keys, "ids_crc32")
    ranked = (
        salted.withColumn("_n", F.row_number().over(own) - 1)
        .join(lower, ["length", "_salt"])
        .withColumn("_rank", F.col("_n") + F.col("_before"))
        .join(F.broadcast(width_of), "length")
        .withColumn("_block", F.floor(F.col("_rank") / F.col("_width")))
    )
    at = F.col("_rank") - F.col("_from")
    return (
        ranked.join(F.broadcast(slot_of), ["length", "_block"])
        .where((F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
        .withColumn("sequence_id", F.col("_sequence") + F.floor(at / F.col("_times")).cast("bigint"))
        .withColumn("offset", F.col("_offset") + F.pmod(at, F.col("_times")) * F.col("length"))
        .select(*pieces.columns, "sequence_id", "offset")
    )


def wasted(counts: dict[int, int], size: int = SIZE) -> float:
    """The share of sequences that a perfect packing of the same ids would not need."""
    many = sum(n for n, _ in pack_histogram(counts, size))
    return 1 - -(-sum(a * n for a, n in counts.items()) // size) / many if many else 0.0


def packed_documents(docs: DataFrame, keep_ids: bool = False, size: int = SIZE) -> DataFrame:
    """Pieces packed into sequences of size; tokenised a second time if rests have to be cut."""
    def pieces(least_cut):
        made = tokenized_pieces(docs, size=size, keep_ids=keep_ids, least_cut=least_cut)
        return written(made if keep_ids else made.drop("ids"), "pieces")

    made = pieces(None)
    histogram = {r["length"]: r["count"] for r in made.groupBy("length").count().collect()}  # at most size rows
    return pack(made if wasted(histogram, size) <= MOST_PADDING else pieces(LEAST_CUT), size)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
