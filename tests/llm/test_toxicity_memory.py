"""Training numbers the words of a text before it reads the next."""

import weakref

import pytest

from rillhouse.llm import toxicity


class _Words(list):
    pass


class _Stop(Exception):
    pass


def test_words_of_one_text_are_held_at_a_time(monkeypatch):
    made, words_of = [], toxicity.words_of

    def kept(text):
        words = _Words(words_of(text))
        made.append(weakref.ref(words))
        return words

    def first_use(words):
        raise _Stop(sum(w() is not None for w in made))

    monkeypatch.setattr(toxicity, "words_of", kept)
    monkeypatch.setattr(toxicity, "parts_of", first_use)
    with pytest.raises(_Stop) as stopped:
        toxicity.train([(f"text number{i} of these", i % 2) for i in range(20)])
    assert len(made) == 20 and stopped.value.args[0] <= 1
