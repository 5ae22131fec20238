"""Token ids of texts by a fixed byte-level BPE vocabulary, a batch at a time."""

import base64
import json
from array import array
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from tokenizers import Tokenizer

from tripmill.llm._common import kept

#: Words whose ids a worker remembers. When full, it begins anew; ids do not depend on it.
REMEMBERED = 120_000

#: Below this character the two libraries' tables of letters and numbers agree.
_COMMON = "ɐ"


class Encoder:
    """Ids as ``tokenizers`` gives them for the JSON vocabulary, without special tokens added.

    A space between two characters that are no blanks always begins a piece that merges never cross. So texts are cut
    there, each different word of a batch is encoded once, and the words' ids are put in the place of the words. A text with
    other blanks beside a space, or with a special token's string, goes to the tokenizer whole. The ids of
    ordinary words come from the same vocabulary's merge ranks (``ranks_path``), which is several times as fast.
    """

    def __init__(self, json_path: str, ranks_path: str | None, pattern: str):
        self.json_path = json_path
        self._tokenizer = None
        self.special = [t["content"] for t in json.loads(Path(json_path).read_text("utf-8")).get("added_tokens", [])]
        self.fast = None
        if ranks_path is not None:
            lines = map(bytes.split, Path(ranks_path).read_bytes().splitlines())
            ranks = {base64.b64decode(a): int(b) for a, b in lines}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._forget()

    @property
    def tokenizer(self) -> Tokenizer:
        """Loaded when a text first needs it: beside the ranks it is as much memory again."""
        if self._tokenizer is None:
            self._tokenizer = Tokenizer.from_file(self.json_path)
        return self._tokenizer

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.ends = array("I"), array("q", [0])

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _piece(self, text: str) -> list[int]:
        if self.fast is not None and (text.isascii() or max(text) < _COMMON):
            return self.fast.encode_ordinary(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _learn(self, word: str) -> int:
        """Keep the ids of the word with a space before it; its number."""
        self.ids.extend(self._piece(" " + word))
        self.ends.append(len(self.ids))
        number = self.known[word] = len(self.ends) - 2
        return number

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and the offsets of the texts. Nulls are empty."""
        texts = texts.fill_null("").cast(pa.large_string())
        n = len(texts)
        if n == 0:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        lists = pc.split_pattern(texts, " ")
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.concatenate([[0], np.cumsum(counts)])
        coded = lists.flatten().dictionary_encode()
        word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        different = coded.dictionary.to_pylist()
        blank = np.array([not w or w[0].isspace() or w[-1].isspace() for w in different], bool)
        other = np.add.reduceat(blank[word].astype(np.int64), at[:-1]) > 0
        for token in self.special:
            other |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        first = np.zeros(len(word), bool)
        first[at[:-1]] = True
        # Words of texts that go whole are not encoded here; neither are first words, which no space precedes.
        needed = np.zeros(len(different), bool)
        plain = ~np.repeat(other, counts) & ~first
        needed[word[plain]] = True
        if len(self.known) >= REMEMBERED:
            self._forget()
        known = self.known.get
        number = np.zeros(len(different), np.int64)
        used = [different[k] for k in np.flatnonzero(needed).tolist()] if not needed.all() else different
        number[needed] = [self._learn(w) if (k := known(w)) is None else k for w in used]
        flat, ends = np.array(self.ids, np.uint32), np.array(self.ends, np.int64)
        # First words, and texts that go whole, come from a table of this batch, behind that of words.
        starts = coded.indices.take(pa.array(at[:-1])).to_pylist()
        own = [
            self.whole(texts[i].as_py()) if apart else np.array(self._piece(different[w]), np.uint32)
            for i, (w, apart) in enumerate(zip(starts, other.tolist(), strict=True))
        ]
        own_length = np.fromiter(map(len, own), np.int64, n)
        begin = np.concatenate([ends[:-1], len(flat) + np.cumsum(own_length) - own_length, [0]])
        length = np.concatenate([np.diff(ends), own_length, [0]])
        flat = np.concatenate([flat, *own])
        # The last entry is that of nothing: of texts that go whole only the first word stands for something.
        at_word = np.where(plain, number[word], len(begin) - 1)
        at_word[at[:-1]] = len(ends) - 1 + np.arange(n)
        size = length[at_word]
        total = np.concatenate([[0], np.cumsum(size)])
        index = np.arange(total[-1]) - np.repeat(total[:-1] - begin[at_word], size)
        return flat[index], total[at]


def encoder(json_path: str, ranks_path: str | None, pattern: str) -> Encoder:
    """One encoder per worker process, until another operator keeps something there."""
    key = ("encoder", json_path, ranks_path, pattern)
    return kept(key, lambda: Encoder(*key[1:]))
