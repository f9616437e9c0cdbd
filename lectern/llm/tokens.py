"""Token ids of whole texts, with words encoded once."""

from __future__ import annotations

import re

TOKENIZER = "word_bpe_49k.json"
# Words of these characters are lower-cased one by one and never recombined, so
# the tokenizer's own split of them can be done here. All others go to it whole.
_SIMPLE = re.compile("[!-~À-ÖØ-öø-ÿ]+")
# Fixed by the tokenizer's file: the pieces it splits a word into.
_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


class WordEncoder:
    """The tokenizer's ids of a text as little-endian unsigned 32-bit bytes.

    The pre-tokenizer never joins characters across white space, so the ids of
    a text are those of its words in turn. A word is looked up, else put
    together from its pieces, each of which the model encodes once. The memory
    is emptied at ``max_words`` words or pieces, which costs time only.
    """

    def __init__(self, path: str | None = None, max_words: int = 400_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or default_path())
        self.model = self.tokenizer.model
        self.max_words, self.words, self.pieces = max_words, {}, {}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # The byte-level alphabet, as the tokenizer itself maps these letters.
        self.letters = {}
        for c in "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿß":
            (mapped, _), = self.tokenizer.pre_tokenizer.pre_tokenize_str(c)
            self.letters[ord(c)] = mapped

    def piece(self, piece: str) -> bytes:
        out = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(piece.translate(self.letters))])
        if len(self.pieces) >= self.max_words:
            self.pieces.clear()
        self.pieces[piece] = out
        return out

    def word(self, word: str) -> bytes:
        if _SIMPLE.fullmatch(word) and not ("<|" in word and any(s in word for s in self.special)):
            known = self.pieces
            out = b"".join([known[p] if p in known else self.piece(p) for p in _PIECE.findall(word.lower())])
        else:
            out = b"".join([i.to_bytes(4, "little") for i in self.tokenizer.encode(word, add_special_tokens=False).ids])
        if len(self.words) >= self.max_words:
            self.words.clear()
        self.words[word] = out
        return out

    def encode(self, text: str) -> bytes:
        """Split at spaces and line ends, which every pre-tokenizer of this kind drops."""
        known = self.words.get
        parts = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return b"".join([known(w) or self.word(w) if w else b"" for w in parts])
