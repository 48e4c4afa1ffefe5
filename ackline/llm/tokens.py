"""Token counts by the whole-token shortcut.

Most pre-tokens of a text are one token of the vocabulary. Which vocabulary
strings are encoded alone as exactly their own token is proved offline, by
encoding every one of them once; a pre-token found in that set needs no merges.
Only the others go through the library's merges, once per worker and distinct
string; its normaliser and pre-tokeniser would leave them as they are.

Pre-tokens never span white space, so a text is cut at white space first and
the tokens of each distinct word are remembered (bounded per worker). A word
with a character outside Latin-1 goes to the library alone, as its
normalisation and letter classes are the library's; all other words of the same
text keep the shortcut.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from ackline.llm.common import map_batches, prepare

# The pre-token pattern of the vocabulary file for texts of
# Latin-1 characters, after lower-casing.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|[^\x09-\x0d\x20\x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼-¾]+"
WORD_END = "</w>"
# Python splits at these, the vocabulary's pattern does not.
SEPARATORS = bytes(range(0x1C, 0x20))

SEPARATED = re.compile("[\x1c-\x1f]").search

# Distinct words a worker remembers before it starts afresh, and the length up to which it does.
REMEMBERED = 1_000_000
LONGEST = 64


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def folded(word: str) -> str:
    """A Latin-1 word in lower case; others as they are, as lower case may depend on more than a character there."""
    return word.lower() if word.isascii() or is_latin(word) else word


class WordEncoder(dict):
    """Maps folded words without white space to their packed token ids."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.pretokens = re.compile(PRETOKEN).findall
        self.whole = self._prove()
        self.packed = [i.to_bytes(4, "little") for i in range(self.library.get_vocab_size(with_added_tokens=True))]
        # The vocabulary spells the bytes of a character by the byte-level alphabet; printable ASCII stands for itself.
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelled = {i: spell(chr(i))[0][0] for i in range(0x100)}

    def _prove(self) -> dict[str, bytes]:
        """Vocabulary strings that alone are encoded as exactly their own token."""
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        names = [n[: -len(WORD_END)] for n in vocabulary if n.endswith(WORD_END)]
        found = self.library.encode_batch_fast(names, add_special_tokens=False)
        return {
            name: vocabulary[name + WORD_END].to_bytes(4, "little")
            for name, e in zip(names, found)
            if e.ids == [vocabulary[name + WORD_END]] and self.pretokens(name) == [name]
        }

    def _merged(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return b"".join([i.to_bytes(4, "little") for i in ids])

    def _learn(self, words: set[str]) -> None:
        """Remember the ids of ``words``, merging each of their other pre-tokens once."""
        if len(self) + len(words) > REMEMBERED:
            self.clear()
        foreign = [word for word in words if not is_latin(word)]
        if foreign:
            found = self.library.encode_batch_fast(foreign, add_special_tokens=False)
            self.update({word: np.array(e.ids, "<u4").tobytes() for word, e in zip(foreign, found)})
        cut = {word: self.pretokens(word) for word in words.difference(foreign)}
        rest = list({p for parts in cut.values() for p in parts if p not in self.whole})
        known = dict(zip(rest, self._merge_each(rest)))
        for word, parts in cut.items():
            self[word] = b"".join([self.whole.get(p) or known[p] for p in parts])

    def _merge_each(self, pretokens: list[str]) -> list[bytes]:
        """Ids of each Latin-1 pre-token, by the library's merges alone: it is normalised and cut already."""
        tokenize, spelled, packed = self.library.model.tokenize, self.spelled, self.packed
        spelt = [p if p.isascii() and p.isprintable() else p.translate(spelled) for p in pretokens]
        return [b"".join([packed[t.id] for t in tokenize(p)]) for p in spelt]

    def words(self, text: str) -> list[str] | None:
        """Folded words of a text; ``None`` if it has to go to the library whole."""
        if "<|" in text and any(s in text for s in self.special):
            return None
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            return None if SEPARATED(text) else list(map(folded, text.split()))
        return text.lower().split() if len(raw.translate(None, SEPARATORS)) == len(raw) else None

    def ids(self, text: str) -> bytes:
        """All token ids of a text as little-endian 32-bit numbers."""
        words = self.words(text)
        if words is None:
            return self._merged(text)
        try:
            return b"".join(map(self.get, words))
        except TypeError:  # a word not met before
            new = {w for w in words if w not in self}
            if len(self) + len(new) > REMEMBERED:
                new = set(words)
            self._learn(new)
            found = b"".join(map(self.get, words))
            for word in new:
                if len(word) > LONGEST:
                    del self[word]
            return found


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def count_tokens(docs: DataFrame, vocabulary: str, *, text: str = "text", limit: int = 2048) -> DataFrame:
    """Add ``n_bytes``, ``n_tokens`` and ``over_limit`` to every row.

    ``vocabulary`` is the path of a word-end BPE file on every executor. Counts
    equal the library's without added special tokens. A null text counts as an
    empty one: no bytes, no tokens. Repeated rows are counted each; columns of
    the same names are replaced, all others kept.
    """
    prepare(docs.sparkSession)
    added = {"n_bytes": LongType(), "n_tokens": LongType(), "over_limit": BooleanType()}
    others = docs.drop(*added)
    fields = [StructField(name, kind) for name, kind in added.items()]
    schema = StructType([*others.schema.fields, *fields])

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode = encoder(vocabulary).ids
        texts = [t or "" for t in batch.column(text).to_pylist()]
        n_bytes = [len(t.encode()) for t in texts]
        n_tokens = [len(encode(t)) // 4 for t in texts]
        columns = [*batch.columns, pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())]
        columns.append(pa.array([n > limit for n in n_tokens], pa.bool_()))
        return pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *added])

    return map_batches(others, count, schema)


def token_count_digest(docs: DataFrame, vocabulary: str, *, limit: int = 2048) -> DataFrame:
    counted = count_tokens(docs.select("doc_id", "text"), vocabulary, limit=limit)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")
