"""Token ids of texts by the tokenizers library, with a cache of the words between blanks.

Both vocabularies in use split a text before they merge, and always do so where one blank
stands between two characters that are no white space. A word between such blanks thus has
the same ids wherever it stands, and a cached word costs a look-up.
"""

import os
import re
import sys
from array import array
from functools import cache

Ids = bytes  # little-endian unsigned 32-bit

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = ".,;:!?"
#: Words of Latin letters and marks, also across single line ends. Both vocabularies split
#: them into runs of letters, runs of marks and line ends.
_SIMPLE = re.compile(f"[{_LETTERS}{_MARKS}]+(?:\n[{_LETTERS}{_MARKS}]+)*")
#: The most common of them: letters, then marks.
_COMMON = re.compile(f"([{_LETTERS}]+)([{_MARKS}]*)").fullmatch
_RUNS = re.compile(f"[{_LETTERS}]+|[{_MARKS}]+|\n")


def _packed(ids: list[int]) -> Ids:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class _Spelling(dict):
    """Code point to how the vocabulary spells the letter, as the library gives it; for `str.translate`."""

    def __init__(self, pieces):
        super().__init__()
        self._pieces = pieces

    def __missing__(self, point: int) -> str:
        self[point] = found = self._pieces(chr(point))[0][0]
        return found


#: Longer words are not cached: one could weigh as much as thousands of others.
_LONGEST = 64
#: Places of the words that were met; one byte each.
_MET = 1 << 20


class Encoder:
    """Ids of whole texts as bytes. Each cache holds two generations of `size` words.

    Runs of letters are cached as they are met. What is quickly put together from them, such as
    a word and a comma, is cached the second time: two in three words of a corpus come once.

    Texts that hold the string of an added token, and words next to other white space, are
    left whole to the library.
    """

    def __init__(self, path: str, size: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._size = size
        self._normalizer = self._tokenizer.normalizer
        self._pre = self._tokenizer.pre_tokenizer
        self._line_end = any(p == "Ċ" for p, _ in self._pieces("a\nb"))
        self._blank = self._pieces(" a")[0][0].removesuffix("a")
        self._lower = self._pieces("A")[0][0] == "a"
        self._spelling = _Spelling(self._pieces)
        # Ids of a word after a blank, of a word that begins a text, of another piece for the merges.
        self._young: list[dict] = [{}, {}, {}]
        self._old: list[dict] = [{}, {}, {}]
        self._met = bytearray(_MET)

    @property
    def vocabulary(self) -> int:
        return self._tokenizer.get_vocab_size()

    def _plain(self, text: str) -> Ids:
        return _packed(self._tokenizer.encode(text, add_special_tokens=False).ids)

    def _remember(self, kind: int, key: str, value: Ids) -> Ids:
        if len(key) > _LONGEST:
            return value
        young = self._young[kind]
        if len(young) >= self._size:
            self._old[kind] = young
            young = self._young[kind] = {}
            if not kind:
                self._met = bytearray(_MET)
        young[key] = value
        return value

    def _remember_again(self, kind: int, key: str, value: Ids) -> Ids:
        """Caches what comes the second time; another word at its place may let it in before."""
        place = hash(key) & (_MET - 1)
        if self._met[place]:
            return self._remember(kind, key, value)
        self._met[place] = 1
        return value

    def _merges(self, piece: str) -> Ids:
        return _packed([t.id for t in self._model.tokenize(piece)])

    def _piece(self, piece: str) -> Ids:
        found = self._young[2].get(piece)
        if found is None:
            found = self._old[2].get(piece)
            if found is None:
                found = self._merges(piece)
            self._remember(2, piece, found)
        return found

    def _letters(self, letters: str) -> Ids:
        """Ids of a run of letters after a blank, cached in the case that the vocabulary has."""
        plain = letters.isascii()
        if plain and self._lower:
            letters = letters.lower()
        found = self._young[0].get(letters)
        if found is None:
            found = self._old[0].get(letters)
            if found is None:
                found = self._merges(self._blank + (letters if plain else letters.translate(self._spelling)))
            self._remember(0, letters, found)
        return found

    def _pieces(self, text: str) -> list:
        if self._normalizer is not None:
            text = self._normalizer.normalize_str(text)
        return self._pre.pre_tokenize_str(text)

    def _unit(self, word: str, first: bool) -> Ids:
        before = "" if first else self._blank
        if not _SIMPLE.fullmatch(word):
            return b"".join([self._piece(p) for p, _ in self._pieces(word if first else " " + word)])
        ids, known = [], self._young[2]
        for run in _RUNS.findall(word):
            if run == "\n":
                if self._line_end:
                    ids.append(self._piece("Ċ"))
                continue
            if before == self._blank and run[0] not in _MARKS:
                ids.append(self._letters(run))
                before = ""
                continue
            if not run.isascii():
                run = run.translate(self._spelling)
            elif self._lower:
                run = run.lower()
            piece = before + run
            ids.append(known.get(piece) or self._piece(piece))
            before = ""
        return b"".join(ids)

    def _word(self, word: str, first: bool) -> Ids | None:
        """None: the word cannot be taken by itself."""
        kind = int(first)
        ids = self._old[kind].get(word)
        if ids is not None:
            return self._remember(kind, word, ids)
        if not first and (common := _COMMON(word)):
            letters, marks = common.groups()
            ids = self._letters(letters)
            if marks:
                ids += self._young[2].get(marks) or self._piece(marks)
            elif not self._lower:
                return ids
            return ids if word in self._young[0] else self._remember_again(0, word, ids)
        if not word or word[0].isspace() or word[-1].isspace() or "᠎" in word:
            return None
        keep = self._remember_again if _SIMPLE.fullmatch(word) else self._remember
        return keep(kind, word, self._unit(word, first))

    def encode(self, text: str) -> Ids:
        for added in self._added:
            if added in text:
                return self._plain(text)
        words = text.split(" ")
        get = self._young[0].get
        found = list(map(get, words))
        found[0] = self._young[1].get(words[0])
        if None in found:
            for i in [i for i, ids in enumerate(found) if ids is None]:
                found[i] = self._word(words[i], i == 0)
            if None in found:
                return self._merged(words, found)
        return b"".join(found)

    def _merged(self, words: list[str], found: list[Ids | None]) -> Ids:
        """Words that cannot stand alone are encoded in one piece with their neighbours."""
        out, run = [], []
        for i, (word, ids) in enumerate(zip(words, found)):
            if ids is None:
                run.append(i)
                continue
            if run and run[-1] == i - 1:
                run.append(i)
                # The next word must begin a unit: this one ends it, being no white space.
                out.append(self._span(words, run))
                run = []
                continue
            following = i + 1 < len(words) and found[i + 1] is None
            if following:
                run = [i]
            else:
                out.append(ids)
        if run:
            out.append(self._span(words, run))
        return b"".join(out)

    def _span(self, words: list[str], run: list[int]) -> Ids:
        text = " ".join(words[run[0]: run[-1] + 1])
        return self._plain(text if run[0] == 0 else " " + text)


@cache
def encoder(path: str, size: int = 400_000) -> Encoder:
    """One encoder for each Python worker; tasks that reuse the worker find its cache filled."""
    return Encoder(path, size)
