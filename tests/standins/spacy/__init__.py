"""A stand-in for a library of language models: places and firms are known, other runs of capitalised words are persons."""

import re
from contextlib import contextmanager


class util:  # noqa: N801
    @staticmethod
    def is_package(name):
        return name in ("en_core_web_md", "en_core_web_sm")


class Entity:
    def __init__(self, m, label):
        self.text, self.start_char, self.label_ = m.group(), m.start(), label


class Doc:
    def __init__(self, text):
        known = [Entity(m, "ORG") for m in re.finditer("Acme|Paris", text)]
        persons = [Entity(m, "PERSON") for m in re.finditer(r"(?!Acme|Paris)[A-Z]\w+(?: (?!Acme|Paris)[A-Z]\w+)+", text)]
        self.ents = known + persons  # not in the order of the text


class Model:
    pipe_names = ["tok2vec", "tagger", "ner"]

    def __init__(self, name):
        self.name, self.off = name, None

    @contextmanager
    def select_pipes(self, disable):
        self.off = disable
        yield

    def pipe(self, texts, batch_size):
        assert self.off == ["tok2vec", "tagger"] and batch_size == 256
        return [Doc(t) for t in texts]


def load(name):
    assert name == "en_core_web_md"  # the first that is there
    return Model(name)
