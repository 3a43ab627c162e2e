"""Texts that hold the tokenizer file's added tokens, against the tokenizer itself."""

import json
import random

import pytest
from tokenizers import Tokenizer

from scoreloom.llm import packing, tokentrees
from scoreloom.llm.tokens import Encoder, default_path
from test_llm_texts import check_pieces

END = "<|endoftext|>"
TEXTS = [f"a{END}b", END, END * 3, f"one  {END}  two", f"one {END}", f"{END}\n\n{END} x", f"<|endof{END}text|>", "<|endoftext|",
         f"it's {END}'s 12{END}34\t{END}\x00é 𝄞", f"{'word ' * 300}{END}{'  other' * 300} {END} end", "no such token"]


def three_edits(text):
    """The edits of ``edit_of_each`` on plain strings."""
    n = len(text)
    third = text[n // 3:n // 3 + 24]
    for at, removed, inserted in ((n // 2, 0, " " + third), (n // 4, min(n // 8, 60), ""), (0, min(n, 5), "Edited:")):
        text = text[:at] + inserted + text[at + removed:]
    return text


def test_ids_are_the_tokenizers():
    encoder, exact = Encoder(), Tokenizer.from_file(default_path())
    assert encoder.ids(f"a{END}b").tolist() == [64, 50256, 65]
    for t in TEXTS:
        assert encoder.ids(t).tolist() == exact.encode(t, add_special_tokens=False).ids
        assert encoder.count(t) == len(encoder.ids(t))


def test_packing_and_trees_know_added_tokens(docs_of):
    exact = Tokenizer.from_file(default_path())
    docs = docs_of([(i, t, "en", "web", len(t)) for i, t in enumerate(TEXTS)])
    check_pieces(packing.pack(docs).collect(), list(enumerate(TEXTS)), exact)
    got = {r.doc_id: r for r in tokentrees.edited_counts(docs).collect()}
    for i, t in enumerate(TEXTS):
        edited = three_edits(t)
        assert got[i].tokens == len(exact.encode(t, add_special_tokens=False).ids)
        assert got[i].edited_chars == len(edited)
        assert got[i].edited_tokens == len(exact.encode(edited, add_special_tokens=False).ids)


@pytest.mark.parametrize("token", [None, {"content": "<| the end |>"}, {"content": "<pad>", "rstrip": True}])
def test_edited_trees_follow_added_tokens(tmp_path, token):
    """Random edits make and break added tokens, also ones that hold or take in white space."""
    path, pool = default_path(), ["a", " ", "  ", "\n", "word", END, END[:6], END[6:]]
    if token:
        with open(path) as f:
            held = json.load(f)
        held["added_tokens"].append({"id": 50_257, "single_word": False, "lstrip": False, "rstrip": False,
                                     "normalized": False, "special": True} | token)
        path = str(tmp_path / "tokenizer.json")
        with open(path, "w") as f:
            json.dump(held, f)
        pool += [token["content"], token["content"][:4], token["content"][4:]] * 2
    encoder, exact, rng = Encoder(path), Tokenizer.from_file(path), random.Random(7)
    for _ in range(20):
        text = "".join(rng.choices(pool, k=60))
        tree = tokentrees.TokenTree.of(text, encoder, 8)
        for _ in range(12):
            at, removed, inserted = rng.randrange(len(text) + 1), rng.randrange(12), "".join(rng.choices(pool, k=2))
            want = text[:at] + inserted + text[at + removed:]
            text, _ = tree.edit(text, at, removed, inserted, encoder, 8)
            assert text == want and int(tree.chars[1]) == len(want)
            assert int(tree.tokens[1]) == len(exact.encode(want, add_special_tokens=False).ids)
