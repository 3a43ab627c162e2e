"""Token ids of whole texts with a byte-level BPE file."""

from __future__ import annotations

import re

import numpy as np

_RUN = re.compile(r"\s\s")
#: Longer runs of blanks overflow the stack of the fast library's pattern engine.
_LONG_RUN = re.compile(r"\s{10000}")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_alphabet() -> dict[str, int]:
    """Bytes by the printable character that byte-level BPE files write for them."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Ids of the tokenizer file at ``path`` (by default the 50k byte-level BPE).

    The vocabulary is read by ``tokenizers``. Its ids are its merge ranks, so ``tiktoken``
    gives the same ids (tested) several times faster. Special tokens are not added, but the
    file's added tokens are recognised in a text: a text that holds one goes to ``tokenizers``.

    The pre-token pattern looks ahead only to leave the last of several white spaces to the
    next token; texts without such runs take the pattern without that alternative, and texts with a
    run of 10,000 blanks or more go to ``tokenizers``.
    """

    def __init__(self, path: str | None = None):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        alphabet = _byte_alphabet()
        self.exact = Tokenizer.from_file(path or default_path())
        added = [t for t in self.exact.get_added_tokens_decoder().values() if t.content]
        self.added = [t.content for t in added]
        # added tokens with a place before white space that is none between tokens, and whether it is their end
        self.joined = [(t.content, bool(t.rstrip)) for t in added if t.rstrip or any(map(str.isspace, t.content))]
        vocab = self.exact.get_vocab(with_added_tokens=False)
        ranks = {bytes(alphabet[c] for c in token): i for token, i in vocab.items()
                 if all(c in alphabet for c in token) and not token.startswith("<|")}
        pattern = public_tokenizers.PATTERN
        self.whole = tiktoken.Encoding("whole", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.plain = tiktoken.Encoding("plain", pat_str=pattern.replace(r"|\s+(?!\S)", ""),
                                       mergeable_ranks=ranks, special_tokens={})

    def _ids(self, text: str) -> list[int]:
        if any(t in text for t in self.added):
            return self.exact.encode(text, add_special_tokens=False).ids
        if not _RUN.search(text):
            return self.plain.encode_ordinary(text)
        if _LONG_RUN.search(text):
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.whole.encode_ordinary(text)

    def ids(self, text: str) -> np.ndarray:
        """All ids of a text as little-endian unsigned 32-bit numbers."""
        return np.array(self._ids(text), "<u4")

    def count(self, text: str) -> int:
        return len(self._ids(text))

    def within_added(self, text: str, place: int) -> bool:
        """Whether a cut at ``place`` may part an added token, or it from the white space that it takes in."""
        return any(text.find(t, max(0, place - len(t) + (not takes)), place + len(t) - 1) >= 0
                   for t, takes in self.joined)
