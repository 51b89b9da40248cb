"""Token ids of texts by a ``tokenizers`` file, with the words it has seen kept per worker."""

from __future__ import annotations

import re
import threading
from collections.abc import Iterable

import numpy as np

#: Marks that compose with an ASCII letter; only then may lower-casing first change the result.
_COMPOSING = re.compile("[̀-ͯ]")
#: Lower-case letters of three scripts that are composed already: one piece, whatever stands around it.
_SIMPLE = re.compile("[a-zß-öø-ÿα-ωа-я]+")
#: ASCII marks; a run of them at a word's end is one piece.
_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Words kept per worker process in each of two generations.
KEPT_WORDS = 600_000
#: Words of texts that wait until what is new in them is encoded.
TOGETHER = 50_000

_models: dict = {}
_lock = threading.Lock()


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class WordTokenizer:
    """Ids of ``Tokenizer.encode(text, add_special_tokens=False)``, word by word.

    For a tokenizer whose pieces never cross a blank, the ids of a text are
    those of its words in order, so each word has to be encoded once; words
    that are new are encoded together.  Texts that could hold a special token
    (``<|``) or composing marks go to the tokenizer as a whole.
    """

    def __init__(self, path: str, kept: int = KEPT_WORDS):
        from tokenizers import Tokenizer, pre_tokenizers
        self.model = Tokenizer.from_file(path)
        # For words that normalising leaves alone and that are one piece: the same merges, without the rest.
        self.bare = Tokenizer(self.model.model)
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.kept = kept
        self.ends_word = np.zeros(self.model.get_vocab_size(), bool)
        for token, i in self.model.get_vocab().items():
            self.ends_word[i] = token.endswith("</w>")
        self.ids_of: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.model.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, words: list[bytes]) -> None:
        """Put the ids of ``words`` into the younger generation; a full one becomes the older."""
        if len(self.ids_of) > self.kept:
            self.older, self.ids_of = self.ids_of, {}
        new = []
        for word in dict.fromkeys(words):
            ids = self.older.get(word)
            if ids is None:
                new.append(word)
            else:
                self.ids_of[word] = ids
        self._learn_new(new)

    def _learn_new(self, new: list[bytes]) -> None:
        # Letters with marks behind them are a piece of letters and one of marks.
        simple, cut, others = [], {}, []
        for word in new:
            if _SIMPLE.fullmatch(word.decode()):
                simple.append(word)
                continue
            letters = word.rstrip(_MARKS)
            if letters and letters != word and _SIMPLE.fullmatch(letters.decode()):
                cut[word] = letters, word[len(letters):]
            else:
                others.append(word)
        simple = [w for w in dict.fromkeys([*simple, *(letters for letters, _ in cut.values())]) if w not in self.ids_of]
        others = [w for w in dict.fromkeys([*others, *(marks for _, marks in cut.values())]) if w not in self.ids_of]
        for at in range(0, len(simple), 512):
            self._learn_plain(simple[at:at + 512], self.bare)
        plain = [w for w in [*simple, *others] if w not in self.ids_of and w.decode().isalpha()]
        for at in range(0, len(plain), 512):
            self._learn_plain(plain[at:at + 512], self.model)
        left = [w for w in [*simple, *others] if w not in self.ids_of]
        for at in range(0, len(left), 4096):
            self._learn_by_offsets(left[at:at + 4096])
        for word, (letters, marks) in cut.items():
            self.ids_of[word] = self.ids_of[letters] + self.ids_of[marks]

    def _learn_plain(self, words: list[bytes], model) -> None:
        """Words of letters alone are one piece each, and a piece ends with a token that ends a word."""
        found = model.encode_batch_fast([b" ".join(words).decode()], add_special_tokens=False)[0]
        ids = np.array(found.ids, "<u4")
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            return  # some are more than one piece after all
        cuts = [0, *(4 * ends).tolist()]
        raw = ids.tobytes()
        self.ids_of.update(zip(words, [raw[a:b] for a, b in zip(cuts, cuts[1:])]))

    def _learn_by_offsets(self, words: list[bytes]) -> None:
        text = [w.decode() for w in words]
        found = self.model.encode(" ".join(text), add_special_tokens=False)
        first = np.array([start for start, _ in found.offsets], np.int64)
        begins = np.cumsum([0] + [len(w) + 1 for w in text])
        cuts = (4 * np.searchsorted(first, begins)).tolist()
        raw = np.array(found.ids, "<u4").tobytes()
        self.ids_of.update(zip(words, [raw[a:b] for a, b in zip(cuts, cuts[1:])]))

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: Iterable[str | None]) -> list[bytes]:
        """``encode`` of each text; the words that are new in some thousand words of texts are encoded together."""
        out: list[bytes] = []
        waiting: list[tuple[int, list[bytes], list[bytes | None]]] = []
        held = 0
        for text in texts:
            if not text:
                out.append(b"")
            elif "<|" in text or not text.isascii() and _COMPOSING.search(text):
                out.append(self._whole(text))
            else:
                words = _parts(text)
                found = list(map(self.ids_of.get, words))
                if None in found:
                    waiting.append((len(out), words, found))
                    held += len(words)
                    out.append(b"")
                    if held > TOGETHER:
                        self._fill(out, waiting)
                        held = 0
                else:
                    out.append(b"".join(found))
        self._fill(out, waiting)
        return out

    def _fill(self, out: list[bytes], waiting: list) -> None:
        """Learn what the ``waiting`` texts lack, and put their ids into ``out``."""
        gaps = [[i for i, ids in enumerate(found) if ids is None] for _, _, found in waiting]
        self._learn([words[i] for (_, words, _), at in zip(waiting, gaps) for i in at])
        for (place, words, found), at in zip(waiting, gaps):
            for i in at:
                found[i] = self.ids_of[words[i]]
            out[place] = b"".join(found)
        waiting.clear()


#: Characters after which a full stop or comma begins a piece of its own: blanks, and letters and digits that stay one
#: letter or digit when lowered (U+0130 does not).  Texts with others there are cut at blanks alone.
_APART = r"\t-\r A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e\u0391-\u03a1\u03a3-\u03a9\u03b1-\u03c9\u0410-\u044f"
_RUN = re.compile(rf"[^{_APART}](?:\.[ \n]|, )")


def _parts(text: str) -> list[bytes]:
    """Words as UTF-8 with A-Z lowered; a full stop or comma at a word's end stands alone."""
    raw = text.encode().lower()
    if not _RUN.search(text):
        raw = raw.replace(b". ", b" . ").replace(b", ", b" , ").replace(b".\n", b" .\n")
    return raw.split()


def tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of ``path`` in this process."""
    with _lock:
        if path not in _models:
            _models[path] = WordTokenizer(path)
        return _models[path]
