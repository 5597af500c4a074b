"""Token ids of whole texts with a public word vocabulary, each distinct run encoded once.

The tokenizer of the file takes a text as runs of letters, single digits and runs of signs,
with blanks between them; each is encoded the same wherever it stands. numpy finds the
borders of many texts at a time, Arrow their distinct runs, and only runs not met before
reach the tokenizer. That is done for words of Latin letters, digits and signs. Any other
word, up to the next blank, is handed to the whole tokenizer as it is.

Results equal `Tokenizer.encode(text, add_special_tokens=False).ids`, in memory bounded by
`SPAN` characters and `REMEMBERED` runs, however long the text is. Only one word without any
border in it has to be encoded in one piece.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

TOKENIZER_FILE = "word_bpe_49k.json"
#: Characters that are split and encoded at a time.
SPAN = 1 << 23
#: Runs that a task remembers before it forgets all of them.
REMEMBERED = 500_000

#: Places where a text may be cut: before a blank, between a digit and a letter or digit, and
#: between a full-width stop and a kana or ideograph.
_BORDER = re.compile(
    r"(?=[ \n])|(?<=[0-9])(?=[0-9A-Za-z])"
    r"|(?<=[、。，！？])(?=[ぁ-ゖァ-ヺ一-鿿])"
)

_OTHER, _BLANK, _LETTER, _DIGIT, _SIGN = range(5)
_SIGNS = b"!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"  # not ' (endings such as 's), nor < (special tokens)


def _classes() -> np.ndarray:
    kind = np.full(256, _OTHER, np.uint8)
    for members, name in (
        (b" \n", _BLANK),
        (b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", _LETTER),
        (b"0123456789", _DIGIT),
        (_SIGNS, _SIGN),
    ):
        kind[list(members)] = name
    return kind


_CLASS = _classes()


def spans(text: str, size: int = SPAN) -> Iterator[str]:
    """A text in parts of some `size` characters that can be encoded one by one."""
    at = 0
    while len(text) - at > size:
        border = _BORDER.search(text, at + size)
        if border is None:
            break
        yield text[at : border.start()]
        at = border.start()
    yield text[at:]


def _runs(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where runs start in a text of UTF-8 bytes, the text with its plain words in lower
    case, and for each byte whether it is in a plain word.

    The letters of Latin-1 are the byte C3 and one more; their capitals lie 32 lower.
    """
    kind = _CLASS[text]
    second = np.zeros(len(text), bool)
    second[1:] = (text[:-1] == 0xC3) & (text[1:] != 0x97) & (text[1:] != 0xB7)
    first = np.zeros(len(text), bool)
    first[:-1] = second[1:]
    kind[first | second] = _LETTER
    starts = np.ones(len(text), bool)
    starts[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    words = np.ones(len(text), bool)
    words[1:] = (kind[1:] == _BLANK) != (kind[:-1] == _BLANK)
    word = np.cumsum(words) - 1
    odd = np.zeros(word[-1] + 1, bool)
    odd[word[kind == _OTHER]] = True
    plain = ~odd[word]
    capital = (text >= 65) & (text <= 90) | second & (text < 0x9F)
    lower = np.where(capital & plain, text + np.uint8(32), text)
    return np.flatnonzero(np.where(plain, starts, words)), lower, plain & (kind != _BLANK)


def _gather(chosen: np.ndarray, lengths: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen ones of lists that lie one after the other in `flat`, as lengths and values."""
    counts = lengths[chosen]
    shift = (np.cumsum(lengths) - lengths)[chosen] - (np.cumsum(counts) - counts)
    return counts, flat[np.repeat(shift, counts) + np.arange(counts.sum())]


class WordEncoder:
    """Encodes texts, and remembers the runs it has met."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.runs_only = Tokenizer(self.whole.model)
        self.runs_only.pre_tokenizer = pre_tokenizers.ByteLevel(
            add_prefix_space=False, use_regex=False
        )
        self._forget()

    def _forget(self) -> None:
        self._number: dict[bytes, int] = {}
        self._lengths, self._ids = array("q"), array("I")

    def _numbers(self, runs: list[bytes], plain: np.ndarray) -> np.ndarray:
        """The number of each distinct run; new ones are encoded."""
        if len(self._number) > REMEMBERED:
            self._forget()
        number = self._number
        fresh = [i for i, run in enumerate(runs) if run not in number]
        for tokenizer, new in (
            (self.runs_only, [runs[i] for i in fresh if plain[i]]),
            (self.whole, [runs[i] for i in fresh if not plain[i]]),
        ):
            texts = [run.decode() for run in new]
            for run, found in zip(new, tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                ids = found.ids
                number[run] = len(number)
                self._lengths.append(len(ids))
                self._ids.extend(ids)
        return np.fromiter(map(number.__getitem__, runs), np.int64, len(runs))

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; together the texts are of some `SPAN` characters."""
        encoded = [text.encode() for text in texts]
        joined = np.frombuffer(b"\n".join([*encoded, b""]), np.uint8)
        if not len(joined):
            return []
        starts, lower, plain = _runs(joined)
        offsets = np.append(starts, len(joined)).astype(np.int32)
        coded = pa.BinaryArray.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(lower)]
        ).dictionary_encode()
        run = coded.indices.to_numpy()
        is_plain = np.zeros(len(coded.dictionary), bool)
        is_plain[run] = plain[starts]
        number = self._numbers(coded.dictionary.to_pylist(), is_plain)
        lengths = np.frombuffer(self._lengths, np.int64)
        counts, ids = _gather(number[run], lengths, np.frombuffer(self._ids or b"", np.uint32))
        ends = np.cumsum([len(e) + 1 for e in encoded])
        bounds = np.concatenate([[0], np.cumsum(counts)])[
            np.searchsorted(starts, np.concatenate([[0], ends - 1]))
        ]
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def encode(self, texts: Iterable[str]) -> Iterator[Iterable[np.ndarray]]:
        """For each text, its ids in one or more parts. Short texts share a pass."""
        waiting: list[str] = []
        size = 0
        for text in texts:
            if size + len(text) > SPAN:
                yield from ([ids] for ids in self._encode(waiting))
                waiting, size = [], 0
            if len(text) > SPAN:
                yield (self._encode([span])[0] for span in spans(text))
            else:
                waiting.append(text)
                size += len(text)
        yield from ([ids] for ids in self._encode(waiting))


@lru_cache(maxsize=2)
def word_encoder(path: str | None = None) -> WordEncoder:
    """The encoder of a tokenizer file, one per Python worker."""
    import public_tokenizers

    return WordEncoder(path or public_tokenizers.path(TOKENIZER_FILE))
