"""Chunk encoders (M5): every chunk of a row, padding included, to a vector of fixed width.

The default encoder counts hashed tokens (``hashed_vector`` is its native
form).  It and a user encoder work on Arrow batches: the
chunk lists of a batch are flattened, encoded ``batch_size`` chunks at a
time and cut into lists again, all inside the row, so no explode, shuffle
or join is needed and rows keep their place whatever their keys are.
"""

from __future__ import annotations

import hashlib
import importlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkwise.functions import text as T
from chunkwise.operators.filters import materialize

ENCODER_DIM = 64
LETTERS_FROM, LETTERS = 0x4E00, 20_000  # one letter stands for each bucket of the native encoder

#: ``make_encoder()`` returns ``fn(np.ndarray[str]) -> np.ndarray[float, (n, width)]``.
MakeEncoder = Callable[[], Callable[[np.ndarray], np.ndarray]]


def hashed_vector(chunk: Column, dim: int = ENCODER_DIM) -> Column:
    """Default chunk encoder: counts of lower-cased tokens by bucket (the
    first seven hex digits of the token's md5, modulo ``dim``),
    L2-normalised; an empty chunk gives zeros.

    The tokens are read once: each becomes the letter of its bucket, and a
    bucket's count is what the letter string loses without that letter.
    """
    if not 0 < dim <= LETTERS:
        raise ValueError(f"dim must be between 1 and {LETTERS}")
    letters = F.lit("".join(chr(LETTERS_FROM + i) for i in range(dim)))

    def letter(token: Column) -> Column:
        bucket = F.conv(F.substring(F.md5(token), 1, 7), 16, 10).cast("int") % dim
        return F.substr(letters, bucket + 1, F.lit(1))

    def counts(s: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: (
            F.length(s) - F.length(F.replace(s, F.substr(letters, i + 1, F.lit(1)), F.lit("")))).cast("double"))

    def unit(c: Column) -> Column:
        n = F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x))
        return T.let(n, lambda norm: F.transform(c, lambda x: F.when(norm > 0, x / norm).otherwise(F.lit(0.0))))

    tokens = F.regexp_extract_all(F.lower(chunk), F.lit(T.TOKEN_JAVA), 0)
    return T.let(T.let(F.array_join(F.transform(tokens, letter), ""), counts), unit)


def chunk_tokens(chunks: Column) -> Column:
    """Lower-cased tokens of each chunk of a list."""
    return F.transform(chunks, lambda c: F.regexp_extract_all(F.lower(c), F.lit(T.TOKEN_JAVA), 0))


TOKENS = 1 << 20  # tokens of a batch that are looked up together


def hashed_matrix(tokens: pa.ListArray, dim: int) -> np.ndarray:
    """``hashed_vector`` of each token list, (lists, dim); a token is hashed once for about ``TOKENS`` of them."""
    sizes = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    out = np.zeros((len(tokens), dim))
    total = np.cumsum(sizes)
    cuts = np.flatnonzero(np.diff(total // TOKENS)) + 1
    for a, z in zip(np.r_[0, cuts], np.r_[cuts, len(tokens)], strict=True):
        words = tokens.slice(a, z - a).flatten().dictionary_encode()
        bucket = np.array([int(hashlib.md5(w.encode()).hexdigest()[:7], 16) % dim for w in words.dictionary.to_pylist()], np.int64)
        at = np.repeat(np.arange(z - a), sizes[a:z]) * dim + bucket[words.indices.to_numpy(zero_copy_only=False)]
        out[a:z] = np.bincount(at, minlength=(z - a) * dim).reshape(z - a, dim)
    norm = np.sqrt((out * out).sum(axis=1))  # sums of whole numbers, the same in any order
    return np.divide(out, norm[:, None], out=np.zeros_like(out), where=norm[:, None] > 0)


def as_lists(m: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()), pa.array(m.ravel()))


def hashed_udf(dim: int) -> Callable[[Column], Column]:
    """Arrow function of ``chunk_tokens`` -> vectors of the native encoder; a null list gives null."""
    @F.arrow_udf("array<array<double>>")
    def encode(lists: pa.Array) -> pa.Array:
        ends = np.r_[0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), as_lists(hashed_matrix(lists.flatten(), dim)), mask=lists.is_null())

    return encode


def named_factory(path: str) -> Callable:
    """The factory that ``package.module:name`` names; imported where it is called."""
    module, _, name = path.partition(":")
    if not module or not name:
        raise ValueError(f"a factory is named package.module:factory, not {path!r}")
    return lambda: getattr(importlib.import_module(module), name)()


_loaded: dict[str, Callable] = {}


def loaded(token: str, make_encoder: MakeEncoder) -> Callable:
    """The encoder of ``token``, made once in each Python worker."""
    if token not in _loaded:
        _loaded[token] = make_encoder()
    return _loaded[token]


def encoder_udf(make_encoder: MakeEncoder, batch_size: int = 64) -> Callable[[Column], Column]:
    """Arrow function ``array<string> -> array<array<double>>``.

    A null list gives null, an empty list an empty one, a null chunk counts
    as an empty text.  The encoder must return one row of numbers a chunk.
    """
    token = uuid.uuid4().hex

    @F.arrow_udf("array<array<double>>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        from chunkwise.operators import encoders  # the worker's own module holds what is loaded

        fn = encoders.loaded(token, make_encoder)
        for lists in batches:
            chunks = np.array([c or "" for c in lists.flatten().to_pylist()], dtype=object)
            parts = [np.asarray(fn(chunks[k:k + batch_size]), dtype=np.float64) for k in range(0, len(chunks), batch_size)]
            for k, p in enumerate(parts):
                if p.ndim != 2 or len(p) != len(chunks[k * batch_size:(k + 1) * batch_size]):
                    raise ValueError(f"the encoder gave shape {p.shape} for {len(chunks[k * batch_size:(k + 1) * batch_size])} chunks")
            vectors = np.concatenate(parts) if parts else np.zeros((0, 0))
            rows = pa.ListArray.from_arrays(pa.array(np.arange(len(vectors) + 1) * vectors.shape[1], pa.int32()), pa.array(vectors.ravel()))
            ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            yield pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), rows, mask=lists.is_null())

    return encode


def encode_chunks(df: DataFrame, chunks: str = "chunks", out: str = "chunk_vecs",
                  make_encoder: MakeEncoder | None = None, dim: int = ENCODER_DIM, batch_size: int = 64) -> DataFrame:
    """M5: every chunk of the ``chunks`` list -> vector.  ``make_encoder``
    brings a user encoder; without it the vectors of ``hashed_vector`` are counted in numpy."""
    if make_encoder is None:
        if not 0 < dim <= LETTERS:
            raise ValueError(f"dim must be between 1 and {LETTERS}")
        return materialize(df, {"_tokens": chunk_tokens(F.col(chunks))}).withColumn(out, hashed_udf(dim)(F.col("_tokens"))).drop("_tokens")
    return df.withColumn(out, encoder_udf(make_encoder, batch_size)(F.col(chunks)))
