"""Token ids of a byte-level BPE tokenizer for groups of whole texts.

The tokenizer must split texts by `public_tokenizers.PATTERN`, which never joins a character with a space
after it, unless the character is white space itself; so a text may be cut before any such space, and its
ids are those of the parts, one after the other. `check_tokenizer` tests both when a file is loaded. A group's texts are split at spaces, their words dictionary-encoded by Arrow, each distinct
word tokenized once, and the words' ids put in the texts' order by one gather. Texts with a space after
white space, or with the string of a special token, go to the library whole.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct words that are tokenized as one text; the tokens' bytes tell where each word ends.
WORDS = 1000
WORDS_RANKS = 50_000


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: What one character of each kind is followed by; what comes before a space must not depend on what comes after.
PROBES = ["a", "Z", "é", "漢", "क", "1", "٣", "_", "'s", "'", "-", "…", "😀", "\u200d", "\u0301", "\x00", "ﬁ"]


def check_tokenizer(tokenizer) -> None:
    """A file whose text is split in another way than ours would give other ids: raise."""
    import public_tokenizers
    import regex

    made = tokenizer.pre_tokenizer
    if made is None or tokenizer.normalizer is not None:
        raise ValueError("this tokenizer does not split texts by the pattern, or it rewrites them")
    text = " ".join(a + b for a in PROBES for b in PROBES) + " \n x  \t y\u00a0z  "
    sizes = [e - b for _, (b, e) in made.pre_tokenize_str(text)]
    if sizes != [len(m[0]) for m in regex.finditer(public_tokenizers.PATTERN, text)]:
        raise ValueError("this tokenizer splits texts by another pattern")
    whole = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
    for a in PROBES:
        for b in PROBES:
            if whole(f"{a} {b}") != whole(a) + whole(f" {b}"):
                raise ValueError(f"this tokenizer joins {a!r} with a space after it")


def load_ranks(path: str, tokenizer):
    """A tiktoken encoding of the same vocabulary; ids of new words come from it, which takes a third of the time."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    if sorted(ranks.values()) != sorted(i for t, i in tokenizer.get_vocab().items() if t not in special):
        raise ValueError(f"{path} holds another vocabulary")
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def ranks_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    return tokenizer_path(name)


def spaced_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, pa.Array]:
    """Distinct words between single spaces, each word's number in the texts' order, the texts' edges in those, and the texts without nulls."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.split_pattern(texts, " ")
    edges = lists.offsets.to_numpy()
    coded = lists.values.slice(edges[0], edges[-1] - edges[0]).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), edges - edges[0], texts


def gather(start: np.ndarray, size: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the items of the runs (start, size) that `index` names, one run after the other, and where each run ends."""
    each = size[index]
    last = np.cumsum(each)
    return np.repeat(start[index] - (last - each), each) + np.arange(int(last[-1]) if len(last) else 0), last


class Encoder:
    """`ranks`: a file of the same vocabulary for tiktoken, if there is one."""

    def __init__(self, path: str, ranks: str | None = None):
        self.tokenizer = load(path)
        check_tokenizer(self.tokenizer)
        self.ranks = load_ranks(ranks, self.tokenizer) if ranks else None
        self.end = _byte_lengths(self.tokenizer)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _plain(self, text: str) -> np.ndarray:
        return self.ranks.encode_to_numpy(text, disallowed_special=()) if self.ranks else self._whole([text])[0]

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of " " + word of each word, one after the other, and how many each has."""
        ids, counts = [], []
        step = WORDS_RANKS if self.ranks else WORDS
        for i in range(0, len(words), step):
            text = " " + " ".join(words[i : i + step])
            raw = np.frombuffer(text.encode(), np.uint8)
            starts = np.flatnonzero(raw == 32)
            got = self._plain(text)
            ends = np.searchsorted(np.cumsum(self.end[got]), np.r_[starts[1:], len(raw)]) + 1
            ids.append(got)
            counts.append(np.diff(ends, prepend=0))
        return np.concatenate(ids or [np.zeros(0, np.uint32)]), np.concatenate(counts or [np.zeros(0, np.int64)])

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32), and the edges of the texts in them (one more than texts). Null is empty."""
        words, index, edges, texts = spaced_words(texts)
        loose = pc.or_(pc.equal(words, ""), pc.utf8_is_space(pc.utf8_slice_codeunits(words, -1, None)))
        for s in self.special:
            loose = pc.or_(loose, pc.match_substring(words, s))
        loose = loose.to_numpy(zero_copy_only=False)
        ids, counts = self._words(words.filter(pa.array(~loose)).to_pylist())
        size = np.zeros(len(words), np.int64)
        size[~loose] = counts
        # the first word of a text has no space before it; a loose text is one entry
        whole = np.add.reduceat(loose[index].astype(np.int64), edges[:-1]) > 0 if len(texts) else np.zeros(0, bool)
        heads = words.take(pa.array(index[edges[:-1]]))
        heads = [t if w else h for t, h, w in zip((t.as_py() if w else None for t, w in zip(texts, whole, strict=True)), heads.to_pylist(), whole, strict=True)]
        head_ids = self._whole(heads)
        start = np.concatenate((np.cumsum(size) - size, len(ids) + np.cumsum([0, *map(len, head_ids)])[:-1])).astype(np.int64)
        size = np.concatenate((size, [len(h) for h in head_ids])).astype(np.int64)
        index[np.repeat(whole, np.diff(edges))] = -1
        index[edges[:-1]] = len(words) + np.arange(len(texts))
        index = index[index >= 0]
        place, last = gather(start, size, index)
        first = np.flatnonzero(index >= len(words))
        out_edges = np.r_[(last - size[index])[first], len(place)].astype(np.int64)
        return np.concatenate((ids, *head_ids)).astype(np.uint32)[place], out_edges


def _byte_lengths(tokenizer) -> np.ndarray:
    """Bytes of each id's token; the byte-level alphabet has one character for each byte."""
    out = np.zeros(tokenizer.get_vocab_size(), np.int64)
    for token, i in tokenizer.get_vocab().items():
        out[i] = len(token)
    return out
