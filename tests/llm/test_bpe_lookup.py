"""The longest match of the BPE operator looks up only lengths that some token has."""

from random import Random

import pytest

pytest.importorskip("public_tokenizers")

from dosecast.llm import bpe  # noqa: E402
from dosecast.llm.common import WORD_BPE, loaded  # noqa: E402


class Counted(dict):
    asked = 0

    def get(self, *args):
        self.asked += 1
        return super().get(*args)


def longest_match(one: bpe.Speculator, word: str) -> list[int] | None:
    at, out, end = 0, [], len(word)
    while at < end:
        if word[at:] in one.final:
            return [*out, one.final[word[at:]]]
        stops = [s for s in range(end - 1 if one.suffix else end, at, -1) if word[at:s] in one.inner]
        if not stops:
            return None
        out.append(one.inner[word[at : stops[0]]])
        at = stops[0]
    return out


def test_longest_match_with_few_lookups(monkeypatch):
    one, draw = loaded(bpe.Speculator, WORD_BPE), Random(5)
    letters = [c for c in one.base if len(c) == 1]
    words = ["".join(draw.choices(letters, k=draw.randrange(30))) for _ in range(2000)]
    tokens = draw.choices(list(one.inner), k=4000)
    words += ["".join(pair) for pair in zip(tokens, tokens[1:])] + ["", "a", "ab"]
    inner = Counted(one.inner)
    monkeypatch.setattr(one, "inner", inner)
    assert [one.proposed(w) for w in words] == [longest_match(one, w) for w in words]
    # one length at a time, these words took nine lookups a symbol
    inner.asked = 0
    for w in words[:2000]:
        one.proposed(w)
    assert inner.asked < 3 * sum(map(len, words[:2000]))
