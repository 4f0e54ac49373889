"""Exact token counts of whole texts, huge ones by overlap resynchronisation (operator 7).

A vocabulary's merges never cross the pieces that its pre-tokeniser cuts, and a cut
depends only on the text after it. So where two overlapping chunks both have a cut
at one place, far enough from the ends that a special string or a look-ahead could
not reach beyond, their encodings agree from there on: tokens of the first chunk up
to the cut and of the second from it are the tokens of the whole. Without a common
cut the overlap widens. Texts of at most one chunk are encoded in units that start
at white space after a visible character, where the pre-tokeniser always cuts;
units repeat, so a task remembers their ids.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Units that a Python worker remembers before it starts over; bounds its memory only.
REMEMBERED = 1_000_000
VOCABULARY = "byte_bpe_50k.json"
#: Characters of a chunk, of the first overlap, and kept clear of a chunk's ends.
CHUNK, OVERLAP, MARGIN = 65_536, 256, 32
LIMIT = 1024
#: White space that starts a unit, after a character that is none.
UNIT = re.compile(r"(?<=\S)(?=[ \t\n\r\f\v])")
LOOSE = re.compile(r"\s ")


class Encoder(dict):
    """Token ids of texts as bytes of unsigned little-endian numbers; remembers units by name."""

    def __init__(self, path: str, plain_specials: bool = False, chunk: int = CHUNK, overlap: int = OVERLAP):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.chunk, self.overlap = chunk, overlap
        longest = max((len(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()), default=0)
        self.margin = max(MARGIN, 2 * longest)

    def __missing__(self, word: str) -> bytes:
        """Of a unit that is a space and `word`."""
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = value = self.direct(" " + word)
        return value

    def encoded(self, text: str):
        return self.tokenizer.encode(text, add_special_tokens=False)

    def direct(self, text: str) -> bytes:
        return np.array(self.encoded(text).ids, dtype=self.kind).tobytes()

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if len(text) > self.chunk:
            return b"".join(self.spliced(text))
        if LOOSE.search(text):
            units = UNIT.split(text)
            rest = [self[u[1:]] if u[0] == " " else self.direct(u) for u in units[1:] if u]
            return b"".join([self.direct(units[0]), *rest])
        first, *rest = text.split(" ")
        return b"".join([self.direct(first) if first else b"", *map(self.__getitem__, rest)])

    def cuts(self, text: str, start: int):
        """Places in the whole text where a piece of the chunk starts, with the token's number."""
        e = self.encoded(text)
        words, offsets = [-1 if w is None else w for w in e.word_ids], e.offsets
        at = [k for k in range(len(words)) if k == 0 or words[k] != words[k - 1]]
        return np.array(e.ids, dtype=self.kind), {start + offsets[k][0]: k for k in at}

    def spliced(self, text: str) -> Iterator[bytes]:
        n = len(text)
        start, end, overlap = 0, min(self.chunk, n), self.overlap
        ids, cuts = self.cuts(text[:end], 0)
        since = 0  # a proven cut: tokens of the chunk count from here
        while end < n:
            after = max(end - overlap, since)
            until = min(after + max(self.chunk, 2 * overlap), n)
            next_ids, next_cuts = self.cuts(text[after:until], after)
            common = [
                p
                for p in cuts.keys() & next_cuts.keys()
                if p > since and p >= after + self.margin and p <= end - self.margin
            ]
            if common:
                at = max(common)
                yield ids[cuts[since] : cuts[at]].tobytes()
                start, end, ids, cuts, since = after, until, next_ids, next_cuts, at
                overlap = self.overlap
            elif after > since:
                overlap *= 2
            else:
                # no cut in the whole chunk: it grows
                end, overlap = min(end + max(self.chunk, end - start), n), self.overlap
                ids, cuts = self.cuts(text[start:end], start)
        yield ids[cuts[since] :].tobytes()


@cache
def worker_encoder(vocabulary: str, plain_specials: bool = False) -> Encoder:
    """The encoder of a Python worker: its remembered units serve all of the worker's tasks."""
    return Encoder(vocabulary_path(vocabulary), plain_specials)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of docs (doc_id, text).

    Tokens are those the library gives for the whole text, without begin and end
    tokens; special strings inside texts count as the library does by default. NULL
    and empty texts have no bytes and tokens. Rows keep their ids, NULL too;
    repeated rows stay repeated; an empty table gives no rows. No shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(vocabulary)
        width = encoder.kind.itemsize
        for batch in batches:
            n = [len(encoder.ids(t)) // width for t in batch.column("text").to_pylist()]
            yield batch.drop_columns(["text"]).append_column("n_tokens", pa.array(n, pa.int64()))

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")
    )
    counted = read.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
