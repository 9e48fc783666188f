"""Token ids by the ``tokenizers`` library inside tasks, each distinct word encoded once."""

import os
import re
import string
import struct

import numpy as np
import pyarrow as pa

from wardlake.llm.common import SPACE, joined

#: Words remembered by one worker in each of two generations; bounds its memory.
REMEMBERED_WORDS = 200_000
#: Longer words are encoded without being remembered.
REMEMBERED_BYTES = 64
#: Words handed to the library in one string, and strings at once; its results outweigh the ids.
WORDS_TOGETHER, STRINGS_AT_ONCE = 64, 32
#: A digit, which the pre-tokenizer sets apart from all neighbours, stands between such words.
BORDER = "\u00b2"

#: Bytes before a mark that is set apart, and such marks.
_SMALL, _MARKS = np.zeros(256, bool), np.zeros(256, bool)
_SMALL[list(string.ascii_lowercase.encode() + string.digits.encode())] = True
_MARKS_CUT = "".join(c for c in string.punctuation if c != "'")
_MARKS[list(_MARKS_CUT.encode())] = True

_encoders: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """Ids of whole texts for a tokenizer whose pre-tokenizer drops white space.

    White space never reaches such a model and no piece spans it, so a text's ids are those of its
    words in order. Words repeat, and each is given to the library once per worker. Where the
    tokenizer itself lowers letters, sets a mark at a word's end apart, or passes plain letters on
    unchanged (all tried when it is loaded), that is done beforehand, so that fewer words differ.
    The tokenizer's special tokens are looked for in the text as it stands, as the library does.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.kind = np.dtype("<u4") if wide else np.dtype("<u2")
        added = self.tokenizer.get_added_tokens_decoder().items()
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word for _, t in added):
            raise ValueError("special tokens that depend on their surroundings are not supported")
        #: Ids of special tokens, under a name that no word has: it begins with a blank.
        self.special = {b" " + t.content.encode(): np.array([i], self.kind).tobytes() for i, t in added}
        cuts = sorted((re.escape(name[1:]) for name in self.special), key=len, reverse=True)
        self.cut = re.compile(b"(" + b"|".join(cuts) + b")") if cuts else None
        self.known: dict[bytes, bytes] = dict(self.special)
        self.older: dict[bytes, bytes] = {}
        ids = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        border = ids(BORDER)
        alone = all(ids(a + BORDER + b) == ids(a) + border + ids(b) for a, b in ("xy", ".'", "12", "'s", BORDER * 2))
        #: The id of the border, when it is one id and borders words as white space does.
        self.border = border[0] if alone and len(border) == 1 else None
        ends, marks = string.ascii_lowercase + string.digits, ".,;:!?"
        self.lowers = all(ids(c) == ids(c.lower()) for c in string.ascii_uppercase)
        apart = all(ids(a + m) == ids(a) + ids(m) for a in ends for m in marks)
        self.mark = re.compile(rb"(?<=[a-z0-9])([.,;:!?])(?=[\x20\x09-\x0D]|\Z)") if apart and self.lowers else None
        model = self.tokenizer.model
        self.direct = lambda word: [t.id for t in model.tokenize(word)]
        form = "<%dH" if self.kind.itemsize == 2 else "<%dI"
        self.packed = [struct.Struct(form % n).pack for n in range(64)]
        #: How a byte-level model writes the bytes 0x80 to 0xC3: the printable ones as themselves.
        hidden = [b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b)]
        self.shown = {b: 256 + i for i, b in enumerate(hidden)}
        shown = lambda w: w.encode().decode("latin-1").translate(self.shown)
        samples = [string.ascii_lowercase[i : i + n] * m for i in range(26) for n in (1, 3, 9) for m in (1, 2)]
        self.plain = all(ids(w) == self.direct(w) for w in samples)
        #: Letters beyond ASCII that reach the model as their bytes, alone and among others.
        more = [c for c in map(chr, range(0xDF, 0x100)) if all(ids(w) == self.direct(shown(w)) for w in (c, c + c, "a" + c, c + "a", "na" + c + "xe", c + "t" + c))]
        accents = b"|\xc3[" + b"".join(re.escape(c.encode()[1:]) for c in more) + b"]" if more else b""
        #: Second bytes of those letters, and whether every mark is set apart from what is before it.
        self.tails = np.zeros(256, bool)
        begin = {a: ids(a) for a in [*ends, *more]}
        follow = {m + z: ids(m + z) for m in _MARKS_CUT for z in ("", "a", "'s")}
        self.cut_marks = self.mark is not None and all(ids(a + m) == begin[a] + follow[m] for a in begin for m in follow)
        self.tails[[c.encode()[1] for c in more]] = True
        self.letters = re.compile(b"(?:[a-z]" + accents + b")+")

    def _words(self, text: bytes) -> list[bytes]:
        """Words of a text, and the names of the special tokens between them."""
        if self.cut is None or not self.cut.search(text):
            return self._plain_words(text)
        parts = self.cut.split(text)  # every second one is a special token
        return [w for k, part in enumerate(parts) for w in ([b" " + part] if k % 2 else self._plain_words(part))]

    def _plain_words(self, text: bytes) -> list[bytes]:
        # marks of U+0300 to U+036F may join a small letter and not its capital
        if self.lowers and b"\xcc" not in text and b"\xcd" not in text:
            small = text.lower()
            # capitals must not become the name of a special token
            text = text if self.cut and self.cut.search(small) else small
        if self.mark:
            text = self.mark.sub(rb" \1", text)
        return text.split()

    def _encode_words(self, words: list[bytes]) -> None:
        """Put the ids of new words among the known ones."""
        if self.plain:
            rest, plain, direct, packed, known = [], self.letters.fullmatch, self.direct, self.packed, self.known
            for word in words:
                if plain(word):
                    ids = direct(word.decode() if word.isascii() else word.decode("latin-1").translate(self.shown))
                    known[word] = packed[len(ids)](*ids) if len(ids) < len(packed) else np.array(ids, self.kind).tobytes()
                else:
                    rest.append(word)
            words = rest
        single = [w for w in words if self.border is None or BORDER.encode() in w]
        if len(single) < len(words):
            rest = [w for w in words if BORDER.encode() not in w]
            groups = [rest[i : i + WORDS_TOGETHER] for i in range(0, len(rest), WORDS_TOGETHER)]
        else:
            groups = []
        groups += [[w] for w in single]
        for at in range(0, len(groups), STRINGS_AT_ONCE):
            part = groups[at : at + STRINGS_AT_ONCE]
            found = self.tokenizer.encode_batch_fast([BORDER.join(map(bytes.decode, g)) for g in part], add_special_tokens=False)
            for group, one in zip(part, found):
                ids = np.array(one.ids, self.kind)
                if len(group) == 1:
                    self.known[group[0]] = ids.tobytes()
                    continue
                cuts = np.flatnonzero(ids == self.border) * self.kind.itemsize
                packed, begin = ids.tobytes(), 0
                for word, end in zip(group, [*cuts.tolist(), len(packed)], strict=True):
                    self.known[word] = packed[begin:end]
                    begin = end + self.kind.itemsize

    def _apart(self, text: bytes, small: bytes) -> bool:
        """Whether a text holds special tokens, or letters that lowering bytes would get wrong."""
        if self.cut and b"<" in text and (self.cut.search(text) or self.cut.search(small)):
            return True
        return self.lowers and (b"\xcc" in text or b"\xcd" in text)

    def _distinct_words(self, texts: list[bytes]) -> tuple[list[bytes], pa.Array, np.ndarray]:
        """Distinct words of all texts, the number of each word in order, and the texts' bounds among them.

        The words lie next to one another once white space is left out. Where the tokenizer sets
        marks apart from the letter before, words end there, too.
        """
        data, at = joined(texts)
        space = SPACE[data]
        solid = ~space
        begins = solid.copy()
        begins[1:] &= space[:-1]
        if self.cut_marks:
            before = _SMALL[data[:-1]]
            before[1:] |= (data[:-2] == 0xC3) & self.tails[data[1:-1]]
            begins[1:] |= before & _MARKS[data[1:]]
        starts = np.flatnonzero(begins)
        letters = data[solid]
        offsets = np.append(np.cumsum(solid)[starts] - 1, len(letters))
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
        numbered = words.dictionary_encode()
        return numbered.dictionary.to_numpy(zero_copy_only=False).tolist(), numbered.indices, np.searchsorted(starts, at)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian integers of ``kind``."""
        small = [t.lower() for t in texts] if self.lowers else texts
        odd = {i: self._words(t) for i, t in enumerate(texts) if self._apart(t, small[i])}
        distinct, numbers, bounds = self._distinct_words([b"" if i in odd else t for i, t in enumerate(small)])
        words = [*distinct, *set().union(*odd.values()).difference(distinct)] if odd else distinct
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED_WORDS:
            self.known, self.older = dict(self.special), self.known
            new = [w for w in words if w not in self.known]
        again = [w for w in new if w in self.older]
        for word in again:
            self.known[word] = self.older[word]
        self._encode_words([w for w in new if w not in self.known] if again else new)
        known = self.known.__getitem__
        taken = pa.array([known(w) for w in distinct], pa.large_binary()).take(numbers)
        ends = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1) if len(taken) else np.zeros(1, np.int64)
        cuts, ids = ends[bounds].tolist(), memoryview(taken.buffers()[2] or b"")
        out = [b"".join(map(known, odd[i])) if i in odd else bytes(ids[a:b]) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        for word in new:
            if len(word) > REMEMBERED_BYTES:
                del self.known[word]
        return out


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
