"""Token ids of public vocabularies, word by word.

Both tokenizers cut a text into words by a pattern and then merge inside each
word, so the ids of a text are those of its words in turn. Words are looked up
once per worker. A text with a character beyond those for which pattern, case and
normal form are certain here, or with a special token spelled out, is given whole
to the library.
"""

from __future__ import annotations

import os
import re
import sys
import types
from collections.abc import Callable

# Characters known to both: tab, line ends, printable ASCII, and letters and signs
# up to U+017F but the dotted capital I, whose lower case has two characters.
_CERTAIN = re.compile("[\t\n\r -~¡-įı-ſ]*")
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ſ"
_NUMBER = "0-9²³¹¼-¾"
_SPACE = "\t\n\r "

# The patterns of the two vocabularies.
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
BYTE_PIECES = (
    f"{_ENDINGS}| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
WORD_PIECES = f"{_ENDINGS}|[{_LETTER}]+|[{_NUMBER}]|[^{_SPACE}{_LETTER}{_NUMBER}]+"

# Words kept per worker; then the store starts anew.
MOST_WORDS = 2_000_000


def kept(name: str, make: Callable[[], object]) -> object:
    """What ``make`` gives, once per Python worker: task code arrives anew with
    every task, so it keeps what is dear in a module of its own."""
    store = sys.modules.setdefault("_llm_worker", types.ModuleType("_llm_worker")).__dict__
    if name not in store:
        store[name] = make()
    return store[name]


class Words(dict):
    """``value(ids)`` of every word met, by word."""

    def __init__(self, path: str, pieces: str, lower: bool, value: Callable[[list[int]], object]) -> None:
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self._pieces = re.compile(pieces).findall
        self._lower = lower
        self._value = value

    def __missing__(self, word: str) -> object:
        if len(self) >= MOST_WORDS:
            self.clear()
        value = self[word] = self._value(self.ids(word))
        return value

    def ids(self, text: str) -> list[int]:
        """The library's ids of a text, without added special tokens."""
        return self.library.encode(text, add_special_tokens=False).ids

    def certain(self, text: str) -> bool:
        return "<|" not in text and _CERTAIN.fullmatch(text) is not None

    def split(self, text: str) -> list[str]:
        """Words of a certain text."""
        return self._pieces(text.lower() if self._lower else text)
