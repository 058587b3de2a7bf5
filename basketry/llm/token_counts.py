"""Token counts by a SentencePiece BPE model, with a shortcut for words that are one token.

No piece of such a model runs over the start of a word (a space after something else) or over a character that
no longer piece holds, such as a line feed, so texts fall apart there into pre-tokens that are encoded alone.
``proven`` lists, once per Python worker and straight from the model, the pre-tokens that are encoded as one
token; these count as one without being encoded. Only the other pre-tokens go through the model's merges, each
once per worker while the memory of ``CACHE`` entries lasts.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
CACHE = 400_000


class Splitter:
    """Pre-tokens of a model and what is known about them before any text is seen."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.model.get_piece_size())
        plain = [i for i in ids if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i))]
        pieces = {i: self.model.id_to_piece(i) for i in plain}
        if any(SPACE in p.lstrip(SPACE) or (p.startswith(SPACE * 2) and p.strip(SPACE)) for p in pieces.values()):
            raise ValueError("a piece runs over the start of a word")
        if self._normalises():
            raise ValueError("the model rewrites texts before it splits them")
        joined = {c for p in pieces.values() if len(p) > 1 for c in p}
        # Line feeds stand in no longer piece, so they end a pre-token on both sides.
        self.breaks = "".join(c for c in "\n\r\t" if c not in joined)
        if "\n" not in self.breaks:
            raise ValueError("a longer piece holds a line feed")
        held = f"[^ {SPACE}{self.breaks}]"
        self.pattern = re.compile(f"[ {SPACE}]+{held}*|{held}+|[{self.breaks}]")
        self.break_tokens = {c: len(self.model.encode("\n" + c)) - len(self.model.encode("\n")) for c in self.breaks}
        self.proven = {p.replace(SPACE, " ") for i, p in pieces.items() if p.startswith(SPACE) and self._ids(p) == [i]}
        self.merged: dict[str, int] = {}

    def _normalises(self) -> bool:
        odd = "ﬁ ｆ Å é  x"
        return "".join(self.model.encode(odd, out_type=str)).split("<0x")[0] != (SPACE + odd.replace(" ", SPACE)).split("ｆ")[0]

    def _ids(self, pre_token: str) -> list[int]:
        """Ids of a pre-token alone: the model itself puts one space before a text."""
        if pre_token[0] in (" ", SPACE):
            return self.model.encode(pre_token[1:]) if len(pre_token) > 1 else [self.model.piece_to_id(SPACE)]
        return self.model.encode("\n" + pre_token)[len(self.model.encode("\n")):]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        total = 0
        for pre_token, times in Counter(self.pattern.findall(" " + text)).items():
            if pre_token in self.proven:
                total += times
                continue
            known = self.merged.get(pre_token)
            if known is None:
                known = self.break_tokens.get(pre_token)
                if known is None:
                    known = len(self._ids(pre_token))
                if len(self.merged) >= CACHE:
                    self.merged.clear()
                if len(pre_token) < 64:
                    self.merged[pre_token] = known
            total += times * known
        return total


@functools.lru_cache(maxsize=4)
def splitter(path: str) -> Splitter:
    return Splitter(path)


def count_tokens(df: DataFrame, text: str = "text", limit: int = 4096, model: str | None = None) -> DataFrame:
    """``df`` with n_bytes (UTF-8), n_tokens and over_limit (more tokens than ``limit``) of ``text``.

    Null and empty texts have 0 bytes and 0 tokens. Rows are independent: repeated rows count alike, an empty
    table gives an empty table, texts of any length are counted whole. Columns of those names are replaced.
    ``model`` is a path that every executor can read.
    """
    path = model or public_tokenizers.path(MODEL)

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = splitter(path).count
        for batch in batches:
            yield pd.Series([count(t) for t in batch], dtype="int64")

    return df.withColumns({
        "n_bytes": F.coalesce(F.octet_length(F.col(text)).cast("long"), F.lit(0).cast("long")),
        "n_tokens": tokens(F.col(text)),
    }).withColumn("over_limit", F.col("n_tokens") > limit)
