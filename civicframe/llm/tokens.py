"""Token ids of whole texts by a public tokenizer whose tokens don't cross white space.

A text is cut at blanks, line ends and between ASCII letters or digits and signs, in lower case, all of which the tokenizer
does itself, and the ids of its parts are joined. Words of other letters with trailing punctuation are cut there too. Ids of
parts seen before come from a bounded table.
"""

from __future__ import annotations

import gc
import os
import re
from itertools import compress
from operator import not_

import numpy as np

from civicframe.llm.common import LOWER

#: Parts of words and whole short texts that a worker remembers, and characters of such a text.
PARTS, TEXTS, SHORT = 1_200_000, 4000, 4096
#: A word of letters and then other signs (but no apostrophe), or any other, a line each.
_SPLIT = re.compile(r"^(?:([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)|(.*))$", re.M)


#: Words whose ids must be the same on the quick way.
PROBE = "der straße élève ñandú reonthhe ÿ ß ### *** &&&.%%% _[]\\^`{|}~ !\"#$%& ()*+,-./ :;<=>?@"
#: A text whose ids must be the same when it is cut.
CUT_PROBE = "It's a.b (c) D-E x1,2. 'S.' .'s a'.b A/B r2.d2 [X]=3; caf\u00e9. \u2014x. h\u0331 H\u0331. =\u0338a <\u0338 <|x|> q?'ll ...and$7%"
#: 1 for ASCII letters and digits, 2 for signs but no apostrophe, 0 for all other bytes.
_KIND = np.zeros(256, np.uint8)
_KIND[33:127] = 2
_KIND[[x for x in range(128) if chr(x).isalnum()]] = 1
_KIND[ord("'")] = 0


def cut_texts(texts: list[str]) -> list[list[str]]:
    """The parts of each text: lower case, cut at blanks, line ends and between ASCII letters or digits and signs."""
    joined = "\n".join([x.replace("\n", " ") for x in texts])
    raw = np.frombuffer(joined.encode(), np.uint8)
    kind = _KIND[raw]
    low = LOWER[raw]
    if not joined.isascii():  # a letter keeps its case before what may be a mark on it: some marks join only one case
        marked = np.flatnonzero(raw[1:] >= 128)
        low[marked] = raw[marked]
    cut = np.insert(low, np.flatnonzero((kind[1:] ^ kind[:-1]) == 3) + 1, 32).tobytes().decode()
    return [list(filter(None, x.split(" "))) for x in cut.split("\n")]


def whole_texts(texts: list[str]) -> list[list[str]]:
    """The words of each text as they are, cut at blanks and line ends only."""
    return [list(filter(None, x.replace("\n", " ").split(" "))) for x in texts]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokenizer:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.parts: dict[str, bytes] = {"": b""}
        self.texts: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        # parts are in lower case and single words already: the same ids come without normalising and searching for words
        self.quick = Tokenizer.from_file(path)
        self.quick.normalizer = None
        self.quick.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        if self._ids(self.quick, PROBE) != self._ids(self.tokenizer, PROBE):
            self.quick = self.tokenizer
        self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cut = cut_texts if self._ids(self.tokenizer, " ".join(cut_texts([CUT_PROBE])[0])) == self._ids(self.tokenizer, CUT_PROBE) else whole_texts

    @staticmethod
    def _ids(tokenizer, text: str) -> list[int]:
        return tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _learn(self, parts: list[str], plain: bool) -> None:
        """plain: each part is one run of letters or of signs, whose last id ends a word."""
        width = self.dtype.itemsize
        for i in range(0, len(parts), 4000):
            some = parts[i : i + 4000]
            ids = np.array(self._ids(self.quick if plain else self.tokenizer, " ".join(some)), self.dtype)
            cut = np.concatenate(([0], np.flatnonzero(self.ends[ids]) + 1)) if plain else ()
            if len(cut) != len(some) + 1:
                got = self.tokenizer.encode(" ".join(some), add_special_tokens=False)  # with offsets
                ids = np.array(got.ids, self.dtype)
                begin = np.concatenate(([0], np.cumsum([len(x) + 1 for x in some])))
                cut = np.searchsorted(np.array([a for a, _ in got.offsets]), begin)
            raw, cut = ids.tobytes(), (cut * width).tolist()
            self.parts.update(zip(some, map(raw.__getitem__, map(slice, cut, cut[1:])), strict=False))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as bytes of ``dtype``."""
        known = self.texts
        new = [x for x in dict.fromkeys(texts) if x not in known]
        collects = gc.isenabled()
        gc.disable()  # many short lists of strings and no cycles: nothing to find
        try:
            got = dict(zip(new, self._encode(new), strict=True))
        finally:
            if collects:
                gc.enable()
        out = [known[x] if x in known else got[x] for x in texts]
        if len(known) > TEXTS:
            known.clear()
        known.update((x, ids) for x, ids in got.items() if len(x) <= SHORT)
        return out

    def _encode(self, texts: list[str]) -> list[bytes]:
        if len(self.parts) > PARTS:
            self.parts = {"": b""}
        parts, low = self.parts, [x.lower() for x in texts]
        plain = [not any(s in x for s in self.special) for x in low]  # the names of special ids aren't cut
        of = {True: iter(self.cut(list(compress(texts, plain)))), False: iter(whole_texts([x for x, p in zip(texts, plain, strict=True) if not p]))}
        split = [next(of[p]) for p in plain]
        got = [list(map(parts.get, x)) for x in split]
        missing = [list(compress(range(len(x)), map(not_, x))) for x in got]
        fresh = {x[i] for x, at in zip(split, missing, strict=True) for i in at}.difference(parts)
        whole = [x for x in fresh if x.isascii() and x.isalpha() and x.islower()]
        self._learn(whole, True)
        fresh = list(fresh.difference(whole))
        for i in range(0, len(fresh), 100_000):
            some = fresh[i : i + 100_000]
            cut = _SPLIT.findall("\n".join(some))
            letters, signs, other = ([x[k] for x in cut] for k in range(3))
            letters = "\n".join(letters).lower().split("\n")  # one by one, as these letters have no context
            self._learn(list(set(letters).union(signs).difference(parts)), True)
            self._learn([x for x in other if x and x not in parts], False)
            parts.update([(x, parts[a] + parts[b]) for x, a, b in zip(some, letters, signs, strict=True) if a and x != a])
        for x, ids, at in zip(split, got, missing, strict=True):
            for i in at:
                ids[i] = parts[x[i]]
        return [b"".join(x) for x in got]


_made: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One of a worker, kept between tasks."""
    if path not in _made:
        _made[path] = WordTokenizer(path)
    return _made[path]
