"""Problem 6: encoding a corpus with a public tokenizer, and decoding it again.

Method: overlapping chunks.  A text longer than a chunk is cut into chunks that
overlap, which are encoded on their own; two neighbours are stitched at the first
place in their overlap where both begin a pre-token with the same bytes (from
there on they agree, because a pre-token depends only on the text from its start
on).  A text whose neighbours never resynchronise (a run without any boundary
longer than the overlap) is encoded in one piece, so the ids are always those of
the whole text.  Chunks of a text stay in its task, and nothing is shuffled.
Giant texts, longer than ``spread``, are cut into parts of that size that other
tasks pre-tokenise, stitch in the same way, and encode.  Decoding concatenates
the raw bytes of the tokens before it decodes them, so characters split over
tokens survive.

Defined results: null and empty texts give an empty list; strings that look like
special tokens are ordinary text; rows that occur twice come out twice; other
columns are ignored.  The tokenizer's file is a parameter and is read on the
executors; it is never copied.
"""

from __future__ import annotations

import os

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_TOKENIZER = "byte_bpe_50k.json"
CHUNK, OVERLAP, SPREAD = 1_024, 128, 262_144
IDS = T.ArrayType(T.IntegerType())

_loaded: dict[str, object] = {}


def tokenizer(path: str):
    """The tokenizer of a file, once per process; a bare name is looked up among the installed public ones."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core already
        from tokenizers import Tokenizer

        where = path
        if os.sep not in path:
            import public_tokenizers

            where = public_tokenizers.path(path)
        loaded = Tokenizer.from_file(str(where))
        loaded.encode_special_tokens = True
        _loaded[path] = loaded
    return _loaded[path]


def _encode(texts: list[str], path: str) -> list[list[int]]:
    return [e.ids for e in tokenizer(path).encode_batch(texts, add_special_tokens=False)]


def _marks(piece: str, path: str, final: bool, chunk: int, overlap: int) -> tuple[list[int], list[int]]:
    """Boundaries of a chunk's pre-tokens: those in the overlap with the chunk before, and those in the overlap with the next, as offsets into that."""
    found = [span[0] for _, span in tokenizer(path).pre_tokenizer.pre_tokenize_str(piece)]
    if not final:
        found = found[:-2]  # these may be cut by the end of the chunk, or by what a look-ahead couldn't see
    # A piece must not end in white space: what its last run of spaces becomes depends on the text behind it.
    return [a for a in found if a < overlap], [a - chunk for a in found if a >= chunk and not piece[a - 1].isspace()]


def stitched(chunks: list, chunk: int, overlap: int) -> list[int] | None:
    """Ids of a text from the encodings of its overlapping chunks; None if two neighbours don't resynchronise."""
    out: list[int] = []
    begin, ids = 0, chunks[0].ids
    for one, two in zip(chunks, chunks[1:]):
        following = two.ids
        safe = (one.token_to_word(len(ids) - 1) or 0) - 2  # the last pre-tokens may be cut by the end of the chunk, or by what a look-ahead couldn't see
        for at in range(1, overlap):
            s, t = one.char_to_token(chunk + at), two.char_to_token(at)
            if s is None or not t or ids[s] != following[t] or one.token_to_chars(s)[0] != chunk + at or two.token_to_chars(t)[0] != at:
                continue
            word = one.token_to_word(s)
            if word <= safe and word != one.token_to_word(s - 1) and two.token_to_word(t) != two.token_to_word(t - 1):
                break  # both begin a pre-token here, with the same bytes
        else:
            return None
        out += ids[begin:s]
        begin, ids = t, following
    return out + ids[begin:]


def encode_texts(texts: list[str], path: str, chunk: int, overlap: int) -> list[list[int]]:
    """Ids of texts, those longer than a chunk by their chunks."""
    cut = [[t[i : i + chunk + overlap] for i in range(0, len(t), chunk)] if len(t) > chunk else [t] for t in texts]
    encoded = iter(tokenizer(path).encode_batch([p for parts in cut for p in parts], add_special_tokens=False))
    out: list[list[int] | None] = []
    for parts in cut:
        own = [next(encoded) for _ in parts]
        out.append(own[0].ids if len(own) == 1 else stitched(own, chunk, overlap))
    again = [n for n, ids in enumerate(out) if ids is None]
    for n, ids in zip(again, _encode([texts[n] for n in again], path)):
        out[n] = ids
    return out


def encode(documents: DataFrame, id_col: str, text_col: str, path: str = DEFAULT_TOKENIZER, chunk: int = CHUNK, overlap: int = OVERLAP, spread: int = SPREAD) -> DataFrame:
    """(id, ids): the token ids of every text."""
    if overlap >= chunk or spread < chunk:
        raise ValueError("the overlap must be shorter than a chunk, and a chunk no longer than what is spread")
    inner, chunk = chunk, spread

    @F.pandas_udf(IDS)
    def encode_whole(texts: pd.Series) -> pd.Series:
        return pd.Series(encode_texts(["" if t is None else t for t in texts], path, inner, overlap))

    spans = T.StructType([T.StructField("head", IDS), T.StructField("tail", IDS)])

    @F.pandas_udf(spans)
    def boundaries(texts: pd.Series, last: pd.Series) -> pd.DataFrame:
        rows = [_marks(t, path, final, chunk, overlap) for t, final in zip(texts, last)]
        return pd.DataFrame(rows, columns=["head", "tail"])

    texts = documents.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("n", F.length("text"))
    short = texts.where(F.col("n") <= chunk).select("id", encode_whole("text").alias("ids"))

    # A row number of its own keeps texts apart that share an id; it isn't used beyond this plan.
    long = texts.where(F.col("n") > chunk).withColumn("row", F.xxhash64("id", "text"))
    copies = long.groupBy("id", "row").agg(F.count("*").alias("copies"), F.first("text").alias("text"), F.first("n").alias("n"))
    cut = copies.select("id", "row", "copies", "n", F.posexplode(F.expr(f"transform(sequence(0, cast(ceil(n / {chunk}) as int) - 1), i -> substring(text, i * {chunk} + 1, {chunk + overlap}))")).alias("i", "piece"))
    cut = cut.withColumn("last", F.col("i") == F.ceil(F.col("n") / chunk).cast("int") - 1)
    marked = cut.withColumn("b", boundaries("piece", "last"))
    order = Window.partitionBy("id", "row").orderBy("i")
    # The stitch with the next chunk, as an offset into that chunk; null if they don't resynchronise.
    common = F.array_min(F.array_intersect(F.col("b.tail"), F.lead("b.head").over(order)))
    stitched = marked.withColumn("to", common).withColumn("from", F.when(F.col("i") == 0, 0).otherwise(F.lag("to").over(order)))
    stitched = stitched.withColumn("broken", F.max(F.when(~F.col("last") & F.col("to").isNull(), 1).otherwise(0)).over(Window.partitionBy("id", "row")))
    piece = F.expr(f"substring(piece, `from` + 1, if(last, n, {chunk} + `to`) - `from`)")
    pieces = stitched.where("broken = 0").select("id", "row", "copies", "i", encode_whole(piece).alias("ids"))
    joined = pieces.groupBy("id", "row", "copies").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("i", "ids"))), lambda s: s["ids"])).alias("ids"))
    # No resynchronisation: the chunks are put together again and the text is encoded in one piece.
    whole = stitched.where("broken = 1").groupBy("id", "row", "copies").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", F.expr(f"substring(piece, 1, {chunk})").alias("part")))), lambda s: s["part"]), "").alias("text")
    )
    rest = whole.select("id", "row", "copies", encode_whole("text").alias("ids"))
    long_ids = joined.unionByName(rest).select("id", "ids", F.explode(F.expr("sequence(1L, copies)"))).select("id", "ids")
    return short.unionByName(long_ids)


def decode(encoded: DataFrame, id_col: str, ids_col: str, path: str = DEFAULT_TOKENIZER) -> DataFrame:
    """(id, text): bytes of all tokens put together, then decoded."""

    @F.pandas_udf(T.StringType())
    def to_text(ids: pd.Series) -> pd.Series:
        loaded = tokenizer(path)
        printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
        byte_of = {chr(b): b for b in printable}
        rest = [b for b in range(256) if b not in printable]
        byte_of |= {chr(256 + k): b for k, b in enumerate(rest)}  # byte-level alphabets write unprintable bytes from U+0100 on
        raw: dict[int, bytes] = {}

        def token(i: int) -> bytes:
            if i not in raw:
                raw[i] = bytes(byte_of[ch] for ch in loaded.id_to_token(i))
            return raw[i]

        return pd.Series(["" if x is None else b"".join(token(int(i)) for i in x).decode("utf-8", "replace") for x in ids])

    return encoded.select(F.col(id_col).alias("id"), to_text(ids_col).alias("text"))
