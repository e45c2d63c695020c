"""Whole texts to token ids with the ``tokenizers`` library, each distinct word encoded once per task.

Both vocabularies used here break a text at white space before anything else, so a text's ids are those of its
words in order. A bounded table of words already seen saves encoding them again; texts whose white space is of
another kind than single blanks and line ends, and texts that hold the name of a special token, are encoded in one
call. The result always equals that call of the library, with the tokenizer as its file describes it.

Where a vocabulary's words carry the blank before them, a line end is the start of a word of its own kind: it takes no
blank, so that the last word of a line and the first of the next are looked up apart.
"""

from __future__ import annotations

import os
import re
import string
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# White space besides the six ASCII blanks, as either library may see it, in the notation of RE2.
OTHER_BLANKS = (
    r"[\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200d}\x{2028}\x{2029}\x{202f}\x{205f}\x{2060}\x{3000}\x{feff}]"
)
ONLY_SINGLE = r"^ |  | $| \n"
# Line ends that the library may take together with the white space around them.
NOT_ALONE = r"[\t\v\f\r]\n|\n[\t\v\f\r]|\n\n[\n ]|\n\n$"
# Words remembered, and the longest of them in bytes.
MAX_WORDS, MAX_LENGTH = 600_000, 64
# Latin words with at most one of these marks behind them need no search for word parts.
MARKS = frozenset(".,;:!?")
ASCII_MARKS = string.punctuation
LAST_LATIN = "\u024f"
# The byte-level alphabet: bytes that are no visible Latin-1 characters stand as the characters from 256 on.
HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
BYTE_CHARS = {b: 256 + i for i, b in enumerate(HIDDEN)}
LED = chr(BYTE_CHARS[ord(" ")])
CALL_WORDS = 2_000
SLICE_BYTES = 24 << 20


class TextEncoder:
    """Ids as 16-bit integers: both vocabularies have under 65,536.

    ``leading`` is for vocabularies whose words carry the blank before them. ``mark`` is a text that is always one
    token of its own between blanks; it parts the words of one call.
    """

    def __init__(self, path: str, leading: bool, mark: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        names = [re.escape(token.content) for token in self.tokenizer.get_added_tokens_decoder().values()]
        # The library reads these names in a text as the token.
        self.odd = "|".join([OTHER_BLANKS, *[ONLY_SINGLE] * leading, *names])
        self.leading, self.mark = leading, mark
        (self.mark_id,) = self.whole(mark)
        # Words already seen, and their ids.
        self.words, self.ids = pa.array([""], pa.string()), pa.array([b""], pa.binary())
        self.marks = {mark: self.whole(mark).tobytes() for mark in MARKS}

    def whole(self, text: str) -> np.ndarray:
        (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, dtype="<u2")

    def latin_word(self, word: str) -> bytes | None:
        """Ids of a word that is one run of Latin letters, with a mark or none; else None."""
        core, tail = (word, "") if word.isalpha() else (word[:-1], word[-1])
        if tail and tail not in MARKS or not core.isalpha() or max(core) > LAST_LATIN or "\u0130" in core:
            return None
        core = core.lower()
        if not core.isascii():
            core = core.encode().decode("latin-1").translate(BYTE_CHARS)
        ids = array("H", [token.id for token in self.tokenizer.model.tokenize(core)]).tobytes()
        return ids + self.marks[tail] if tail else ids

    def new_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each word; those that could hold the mark are encoded alone."""
        found = {w: ids for w in words if (ids := self.latin_word(w)) is not None}
        words = [w for w in words if w not in found]
        plain = [w for w in words if self.mark not in w]
        found.update((w, self.whole(w).tobytes()) for w in words if self.mark in w)
        found.update(zip(plain, self.in_calls(plain, f" {self.mark} ")))
        return found

    def led_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words with a blank before them, or with the line end that they begin with.

        A core is a word without the ASCII marks at its end, which are a part of their own behind a Latin letter or digit.
        """
        found, line_end, tails, others = {}, self.mark_id.tobytes(), {}, []
        tokenize = self.tokenizer.model.tokenize
        for w in words:
            core = w.rstrip(ASCII_MARKS)
            if core == w or not core or core[-1] > LAST_LATIN or not core[-1].isalnum():
                core = w
            if core not in found:
                at_line = core[0] == "\n"
                rest = core[1:] if at_line else core
                if not rest.isalpha() or not rest.isascii() and max(rest) > LAST_LATIN:
                    others.append(w)
                    continue
                if rest.isascii():
                    rest = rest if at_line else LED + rest
                else:
                    rest = (rest if at_line else " " + rest).encode().decode("latin-1").translate(BYTE_CHARS)
                ids = array("H", [token.id for token in tokenize(rest)]).tobytes()
                found[core] = line_end + ids if at_line else ids
            if core is not w:
                tail = w[len(core) :]
                if tail not in tails:
                    tails[tail] = self.whole(tail).tobytes()
                found[w] = found[core] + tails[tail]
        plain, lines = [], []
        for w in others:
            rest = w[1:] if w[0] == "\n" else w
            if rest.split() != [rest]:  # white space within
                found[w] = self.whole(w if w[0] == "\n" else " " + w).tobytes()
            else:
                (plain if rest is w else lines).append(w)
        found.update(zip(plain, self.in_calls([" " + w for w in plain], self.mark)))
        found.update((w, line_end + ids) for w, ids in zip(lines, self.in_calls([w[1:] for w in lines], self.mark)))
        return found

    def in_calls(self, words: list[str], part: str) -> Iterator[bytes]:
        """Ids of each word, of many in one call, where the mark parts them."""
        for i in range(0, len(words), CALL_WORDS):
            some = words[i : i + CALL_WORDS]
            ids = self.whole(part.join(some))
            ends = [*np.flatnonzero(ids == self.mark_id).tolist(), len(ids)]
            raw, at = ids.tobytes(), 0
            for _, end in zip(some, ends, strict=True):
                yield raw[2 * at : 2 * end]
                at = end + 1

    def of_words(self, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """An array of ids and the place of each word's in it."""
        n, known = len(self.words), self.ids
        coded = pa.concat_arrays([self.words, words]).dictionary_encode()  # the words already seen keep their places
        place = coded.indices.to_numpy()[n:].astype(np.int64)
        new = coded.dictionary[n:].to_pylist()
        if not new:
            return known, place
        found = self.led_words(new) if self.leading else self.new_words(new)
        ids = pa.concat_arrays([known, pa.array([found[w] for w in new], pa.binary())])
        if n < MAX_WORDS:
            kept = [w for w in new if len(w) <= MAX_LENGTH]
            self.words = pa.concat_arrays([self.words, pa.array(kept, pa.string())])
            self.ids = pa.concat_arrays([known, pa.array([found[w] for w in kept], pa.binary())])
        return ids, place

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For slices of ``texts`` in order: all ids, and the bounds of each text's. Null texts have none."""
        texts = pc.fill_null(texts, "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        room = ends[-1] // -(-ends[-1] // SLICE_BYTES) + 1 if len(ends) and ends[-1] else 1  # slices of about equal size
        at = 0
        while at < len(texts):
            before = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + room, side="right")))
            yield self.encode_slice(texts.slice(at, end - at))
            at = end

    def encode_slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        odd = pc.match_substring_regex(texts, self.odd)
        odd_at = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        plain = pc.if_else(odd, "", texts)
        if self.leading:
            apart = pc.replace_substring(plain, "\n", " \n")
            plain = pc.if_else(pc.match_substring_regex(texts, NOT_ALONE), plain, apart)
        lists = pc.split_pattern(plain, " ") if self.leading else pc.ascii_split_whitespace(plain)
        bounds = lists.offsets.to_numpy().astype(np.int64)
        bounds = bounds - bounds[0]
        words = lists.flatten()
        parts, at = self.of_words(words)
        if self.leading:  # a text's first word has no blank before it
            firsts = pc.take(words, pa.array(bounds[:-1])).dictionary_encode()
            own = firsts.dictionary.to_pylist()
            plain = [w for w in own if w.split() == [w]]
            found = dict(zip(plain, self.in_calls(plain, self.mark)))
            own = [found[w] if w in found else self.whole(w).tobytes() for w in own]
            at[bounds[:-1]] = len(parts) + firsts.indices.to_numpy()
            parts = pa.concat_arrays([parts, pa.array(own, pa.binary())])
        if len(odd_at):  # an odd text stands as one empty word until here
            at[bounds[odd_at]] = len(parts) + np.arange(len(odd_at))
            odd = [self.whole(t).tobytes() for t in pc.take(texts, pa.array(odd_at)).to_pylist()]
            parts = pa.concat_arrays([parts, pa.array(odd, pa.binary())])
        coded = pc.take(parts, pa.array(at))
        _, offsets, raw = coded.buffers()
        ends = np.frombuffer(offsets, dtype=np.int32, count=len(coded) + 1)
        return np.frombuffer(raw or b"", dtype="<u2", count=ends[-1] // 2), ends[bounds].astype(np.int64) // 2


@lru_cache(maxsize=1)
def byte_bpe(path: str | None = None) -> TextEncoder:
    """One for each process, so that its tasks share the words already seen."""
    import public_tokenizers

    return TextEncoder(path or public_tokenizers.path("byte_bpe_50k.json"), leading=True, mark="\n")


def word_bpe(path: str | None = None) -> TextEncoder:
    import public_tokenizers

    return TextEncoder(path or public_tokenizers.path("word_bpe_49k.json"), leading=False, mark="$")
