"""Token counts of documents without their ids.

A document's tokens are the sum over its pre-tokens (the pieces of normalised text that the tokenizer's merges never
cross) of the pieces of each. So the pieces are counted once for each distinct pre-token of the whole corpus, and the
counts are joined to the documents' pre-token frequencies:

1. one pass over the texts gives every document's distinct pre-tokens and how often each occurs; the table is kept in
   the shared folder, as both of the next steps read it;
2. the distinct pre-tokens of all documents go through the tokenizer's model, each once;
3. the pre-tokens of the most documents, ``HEAD_ROWS`` at most and none longer than ``HEAD_CHARS``, are
   broadcast: a bound whatever the corpus. They take nearly all rows, the hot keys with them. The others are joined by
   a shuffle, in which no key has more rows than the least of the broadcast ones; Spark splits what is still uneven
   (a very long pre-token that many documents share).

A null text is an empty one and has no tokens. The strings of special tokens count as the library takes them by default,
one token each. Repeated rows and repeated or null ids are each counted on their own. An empty table gives no rows. Other
columns are not looked at, whatever their names.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.storage import staged

HEAD_ROWS = 1 << 18
HEAD_CHARS = 64
#: Pre-tokens of documents handed on together.
FLUSH_PRE_TOKENS = 200_000
#: Characters below this are of the same class and case in every Unicode version and are in composed form.
_COMMON, _DOTTED = "ɐ", "İ"
#: White space of the tokenizer's patterns among them.
_WHITE = r"\t-\r \x85\xa0"


def _byte_symbols() -> list[str]:
    """The printable character that byte-level files write for each byte."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class PreTokenizer:
    """A ``tokenizers`` file's way from a text to what its model is given, and the model's counts.

    Texts with common characters alone, in files that lower-case and then split by one pattern, are split
    by that pattern here, several times faster than through the library, which takes all others.
    """

    _by_path: dict[str, PreTokenizer] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        added = content["added_tokens"]
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("added tokens must be plain strings of the text")
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.fast = self._pattern(content)
        self.symbols = _byte_symbols()

    @classmethod
    def of(cls, path: str) -> PreTokenizer:
        """One for each worker process, kept over its tasks."""
        if path not in cls._by_path:
            cls._by_path[path] = cls(path)
        return cls._by_path[path]

    @staticmethod
    def _pattern(content: dict) -> regex.Pattern | None:
        steps = [s["type"] for s in (content["normalizer"] or {}).get("normalizers", [])]
        split, *after = (content["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        byte_level = [(s["type"], s.get("use_regex"), s.get("add_prefix_space")) for s in after] == [("ByteLevel", False, False)]
        drops_rest = (split.get("type"), split.get("behavior"), split.get("invert")) == ("Split", "Removed", True)
        if steps != ["NFC", "Replace", "Lowercase"] or not byte_level or not drops_rest:
            return None
        return regex.compile(split["pattern"]["Regex"].replace(r"\s", _WHITE))

    def frequencies(self, text: str) -> tuple[int, Counter]:
        """Number of special tokens, and how often each pre-token occurs."""
        if self.special is None or not (parts := self.special.split(text))[1:]:
            return 0, self._of_part(text)
        found: Counter = Counter()
        for part in parts:
            found += self._of_part(part)
        return len(parts) - 1, found

    def _of_part(self, text: str) -> Counter:
        if not text:
            return Counter()
        if self.fast is None or max(text) >= _COMMON or _DOTTED in text:
            shown = self.tokenizer.normalizer.normalize_str(text) if self.tokenizer.normalizer else text
            return Counter(token for token, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(shown))
        return Counter({self._as_symbols(w): n for w, n in Counter(self.fast.findall(text.lower())).items()})

    def _as_symbols(self, word: str) -> str:
        if word.isascii() and word.isprintable():
            return word
        return "".join([self.symbols[b] for b in word.encode()])

    def pieces(self, pre_token: str) -> int:
        return len(self.tokenizer.model.tokenize(pre_token))


def pre_token_frequencies(documents: DataFrame, tokenizer_path: str) -> DataFrame:
    """(doc_id, n_bytes, n_special, tokens, counts): a row per document with its distinct pre-tokens."""
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre = PreTokenizer.of(tokenizer_path)
        for batch in batches:
            rows, size = [], 0
            kinds = [batch.schema.field(0).type, pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())]
            for doc_id, n_bytes, text in zip(*batch.columns):
                n_special, found = pre.frequencies(text.as_py() or "")
                rows.append((doc_id.as_py(), n_bytes.as_py(), n_special, list(found), list(found.values())))
                size += len(found)
                if size >= FLUSH_PRE_TOKENS:
                    yield _batch(rows, kinds)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, kinds)

    text = F.col("text").cast("string")
    rows = documents.select("doc_id", F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), text.alias("text"))
    return rows.mapInArrow(counted, f"doc_id {id_type}, n_bytes long, n_special long, tokens array<string>, counts array<long>")


def _batch(rows: list[tuple], kinds: list[pa.DataType]) -> pa.RecordBatch:
    names = ["doc_id", "n_bytes", "n_special", "tokens", "counts"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def piece_counts(pairs: DataFrame, tokenizer_path: str) -> DataFrame:
    """(token, n_docs, pieces): every distinct pre-token of the (token, count) rows, counted once."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre = PreTokenizer.of(tokenizer_path)
        for batch in batches:
            pieces = pa.array([pre.pieces(token.as_py()) for token in batch.column(0)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, pieces], names=["token", "n_docs", "pieces"])

    distinct = pairs.groupBy("token").agg(F.count("*").alias("n_docs"))
    return distinct.mapInArrow(counted, "token string, n_docs long, pieces long")


def head_bound(dictionary: DataFrame, head_rows: int) -> int:
    """The least number of documents that at most ``head_rows`` pre-tokens reach, to five leading bits; from a few hundred numbers."""
    low = F.greatest(F.length(F.bin("n_docs")) - 5, F.lit(0))
    sizes = dictionary.groupBy(F.col("n_docs").bitwiseAND(F.call_function("shiftleft", F.lit(-1).cast("long"), low)).alias("least")).agg(F.count("*").alias("n"))
    total, bound = 0, 1 << 62
    for row in sorted(sizes.collect(), reverse=True):
        total += row["n"]
        if total > head_rows:
            break
        bound = row["least"]
    return bound


def count_tokens(documents: DataFrame, tokenizer_path: str, head_rows: int = HEAD_ROWS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every document."""
    texts = staged(pre_token_frequencies(documents, tokenizer_path).withColumn("row", F.monotonically_increasing_id()), codec="zstd")
    pairs = texts.select("row", F.inline(F.arrays_zip("tokens", "counts")).alias("token", "count"))
    dictionary = staged(piece_counts(pairs, tokenizer_path))
    is_head = (F.col("n_docs") >= head_bound(dictionary, head_rows)) & (F.length("token") <= HEAD_CHARS)
    head = F.broadcast(dictionary.where(is_head).select("token", "pieces"))
    tail = dictionary.where(~is_head).select("token", "pieces")
    found = _products(pairs.join(head, "token"))
    if not tail.isEmpty():
        rare = pairs.join(head.select("token"), "token", "left_anti")
        found = found.union(_products(rare.join(tail, "token")))
    sums = found.groupBy("row").agg(F.sum("n").alias("n"))
    return (
        texts.select("row", "doc_id", "n_bytes", "n_special")
        .join(sums, "row", "left")
        .select("doc_id", "n_bytes", (F.col("n_special") + F.coalesce("n", F.lit(0))).alias("n_tokens"))
    )


def _products(joined: DataFrame) -> DataFrame:
    return joined.select("row", (F.col("count") * F.col("pieces")).alias("n"))
