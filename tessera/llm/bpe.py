"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

The vocabulary comes from a rank file (base64 token, rank).  Every byte maps to a printable
character, tokens are written in these characters, and the merge that makes each token is
found from the ranks, which gives a ``tokenizers`` BPE model with the same result as merging
by lowest rank.  Texts are cut into the matches of ``public_tokenizers.PATTERN``; each
distinct match of a batch is encoded once and the ids of the texts are gathered from these.
Texts below U+0250 are cut by an equivalent pattern with spelled-out letter and number
ranges, others by the library's own splitter, so that Unicode classes are the library's.

Decoding maps ids to token characters, reverses the byte table and joins bytes before any
UTF-8 decoding, so characters split between tokens come back whole; ids that end inside a
character decode to U+FFFD in text output and to the exact bytes in binary output.

Null text counts as empty; an empty text has no ids.  Rows are independent: repeated rows
and ties need no rule, an empty table gives an empty table, other columns are kept and an
output column whose name is taken gets a trailing underscore.  One text is handled whole;
batches are cut to about 2 MB of text.  Unknown ids decode to nothing.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import extended, fresh, prepare, small_batches, utf8_parts

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_L = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
#: PATTERN for texts below U+0250; only the last four alternatives can meet, in this order.
LATIN = re.compile(rf" ?[{_L}]+| ?[{_N}]+|'(?:[stmd]|re|ve|ll)| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+")
BEYOND_LATIN = re.compile("[ɐ-\U0010ffff\x1c-\x1f]")
CACHED_PIECES = 100_000


def byte_characters() -> list[str]:
    """Byte -> character: printable Latin-1 bytes stand for themselves, the others follow U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, following = [""] * 256, 0x100
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b] = chr(following)
            following += 1
    return out


def merge_of(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two parts that lowest-rank-first merging leaves just before ``token``."""
    parts = [bytes([b]) for b in token]
    limit = ranks[token]
    while len(parts) > 2:
        rank, i = min((ranks.get(a + b, limit), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank >= limit:
            raise ValueError(f"token {token!r} is not made by merges of lower rank")
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


class ByteBPE:
    """Encoder and decoder of one rank file; made once in each Python worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
        chars = byte_characters()
        written = {t: "".join(chars[b] for b in t) for t in self.ranks}
        merges = [tuple(written[p] for p in merge_of(t, self.ranks))
                  for t in sorted(self.ranks, key=self.ranks.get) if len(t) > 1]
        vocab = {written[t]: r for t, r in self.ranks.items()}
        self.model = Tokenizer(models.BPE(vocab=vocab, merges=merges))
        self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.splitter = pre_tokenizers.Split(Regex(PATTERN), "isolated")
        back = {c: b for b, c in enumerate(chars)}
        by_id = [b""] * (max(vocab.values()) + 1)
        for w, i in vocab.items():
            by_id[i] = bytes(back[c] for c in w)
        self.token_bytes = pa.array(by_id, pa.large_binary())
        self.token_digits = pa.array([b"%d," % i for i in range(len(by_id))], pa.large_binary())
        self.pieces: dict[str, list[int]] = {}

    def split(self, text: str) -> list[str]:
        if BEYOND_LATIN.search(text) is None:
            return LATIN.findall(text)
        return [piece for piece, _ in self.splitter.pre_tokenize_str(text)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets (n + 1) and the joined ids of the texts."""
        split = [self.split(t) if t else [] for t in texts]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        found = pa.array(chain.from_iterable(split), pa.string(), size=int(counts.sum())).dictionary_encode()
        distinct = found.dictionary.to_pylist()
        del split
        if len(self.pieces) > CACHED_PIECES:
            self.pieces.clear()
        new = [p for p in distinct if p not in self.pieces]
        for p, e in zip(new, self.model.encode_batch_fast(new, add_special_tokens=False)):
            self.pieces[p] = e.ids
        ids = [self.pieces[p] for p in distinct]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum()))
        lists = pa.LargeListArray.from_arrays(np.append(0, np.cumsum(lengths)), flat)
        which = found.indices.to_numpy()
        out = lists.take(found.indices).flatten().to_numpy()
        ends = np.append(0, np.cumsum(lengths[which]))
        return ends[np.append(0, np.cumsum(counts))], out

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte offsets of the tokens (n + 1) and the joined bytes."""
        known = ids[(ids >= 0) & (ids < len(self.token_bytes))]
        taken = self.token_bytes.take(pa.array(known))
        offsets, data = utf8_parts(taken)
        if len(known) == len(ids):
            return offsets, data
        lengths = np.zeros(len(ids), np.int64)
        lengths[(ids >= 0) & (ids < len(self.token_bytes))] = np.diff(offsets)
        return np.append(0, np.cumsum(lengths)), data

    def character_spans(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character and last character + 1 that each token has bytes of, in one text."""
        offsets, data = self.decode(ids)
        starts_char = np.append(0, np.cumsum((data & 0xC0) != 0x80))
        return starts_char[offsets[:-1] + 1] - 1, starts_char[offsets[1:]]


_codecs: dict[str, ByteBPE] = {}


def codec(path: str) -> ByteBPE:
    if path not in _codecs:
        _codecs[path] = ByteBPE(path)
    return _codecs[path]


def _texts(batch: pa.RecordBatch, column: str) -> list[str]:
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def encode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "token_ids",
           spans: bool = False) -> DataFrame:
    """``df`` with the ids of ``text_col`` (array<int>); with ``spans`` also ``token_starts``
    and ``token_ends``, the characters (code points) that each token has bytes of."""
    prepare(df.sparkSession)
    names = [fresh(df, ids_col)] + ([fresh(df, "token_starts"), fresh(df, "token_ends")] if spans else [])
    schema = extended(df, **dict.fromkeys(names, "array<int>"))

    def run(batches):
        bpe = codec(path)
        for batch in small_batches(batches, column=text_col):
            ends, ids = bpe.encode(_texts(batch, text_col))
            columns = [ids]
            if spans:
                pairs = [bpe.character_spans(ids[a:b]) for a, b in zip(ends, ends[1:])]
                columns += [np.concatenate([p[i] for p in pairs]).astype(np.int32) for i in (0, 1)]
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(c, pa.int32())) for c in columns]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], [*batch.schema.names, *names])
        bpe.pieces.clear()  # the worker lives on

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids_col: str = "token_ids", out_col: str = "decoded",
           binary: bool = False) -> DataFrame:
    """``df`` with the text (or exact bytes) that the ids stand for; null ids give null."""
    prepare(df.sparkSession)
    out_col = fresh(df, out_col)

    def run(batches):
        bpe = codec(path)
        for batch in batches:
            out = []
            for ids in batch.column(batch.schema.get_field_index(ids_col)):
                if ids.as_py() is None:
                    out.append(None)
                    continue
                data = bpe.decode(ids.values.drop_null().to_numpy())[1].tobytes()
                out.append(data if binary else data.decode("utf-8", "replace"))
            column = pa.array(out, pa.binary() if binary else pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, out_col])

    return df.mapInArrow(run, extended(df, **{out_col: "binary" if binary else "string"}))


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes every text and decodes its ids; per row the token count and SHA-256 digests of
    the ids (decimal, joined by commas) and of the decoded bytes.  Ids stay in the task."""
    prepare(df.sparkSession)

    def sha(data, a, b):
        return hashlib.sha256(data[a:b]).hexdigest()

    def run(batches):
        bpe = codec(path)
        for batch in small_batches(batches, column=text_col):
            ends, ids = bpe.encode(_texts(batch, text_col))
            at, data = bpe.decode(ids)
            d_at, digits = utf8_parts(bpe.token_digits.take(pa.array(ids)))
            rows = list(zip(ends, ends[1:]))
            yield pa.RecordBatch.from_arrays([
                batch.column(batch.schema.get_field_index(id_col)),
                pa.array(np.diff(ends), pa.int64()),
                pa.array([sha(digits, d_at[a], max(d_at[a], d_at[b] - 1)) for a, b in rows], pa.string()),
                pa.array([sha(data, at[a], at[b]) for a, b in rows], pa.string()),
            ], [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])
        bpe.pieces.clear()  # the worker lives on

    kind = dict(df.dtypes)[id_col]
    return df.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
