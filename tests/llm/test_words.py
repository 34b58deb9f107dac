import random
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest

from linecraft.llm import _words
from linecraft.llm.fm_index import WORD
from linecraft.llm.weak_toxicity import STEM
from linecraft.llm.weak_toxicity import WORD as LETTERS

from .fixtures_llm import prose


def texts():
    r = random.Random(4)
    mixed = "".join(r.choice("aB é.,-9\n\U0001f600") for _ in range(4000))
    return [prose(1, 700), None, "", mixed, "x" * 900, " " * 900, "é" * 500, "a", "b", "a" + "." * 300 + "b", prose(2, 90)]


@pytest.mark.parametrize("own", [WORD, LETTERS])
@pytest.mark.parametrize("run", [1, 7, 64, 1000])
def test_runs_give_the_words_of_the_whole(monkeypatch, own, run):
    a = pa.array(texts())
    whole = _words.words_of(a, own, STEM)
    monkeypatch.setattr(_words, "RUN", run)
    got = _words.words_of(a, own, STEM)
    for part in ("hashes", "first", "starts", "stems"):
        assert getattr(got, part).tolist() == getattr(whole, part).tolist()
    assert _words.words_of(a, own).hashes.tolist() == whole.hashes.tolist()


def test_words_at_text_borders():
    w = _words.words_of(pa.array(["ab", "ab", "", "a b"]), WORD)
    assert np.diff(w.first).tolist() == [1, 1, 0, 2] and w.hashes[0] == w.hashes[1]
    assert len(_words.words_of(pa.array([], pa.string()), WORD).hashes) == 0
    assert len(_words.words_of(pa.array(["", None]), WORD).hashes) == 0


@pytest.mark.parametrize("size", [1, 2, 5])
@pytest.mark.parametrize("n", [9, 10, 200, 1201])
def test_shingles_of_a_long_text_in_parts(monkeypatch, size, n):
    w = _words.words_of(pa.array([prose(n, n)]), WORD)
    whole, first = _words.shingles_of(w, size)
    monkeypatch.setattr(_words, "RUN", 64)
    got, at = _words.shingles_of(w, size)
    assert got.tolist() == whole.tolist() and at.tolist() == first.tolist()


CHILD = """
import sys, resource
import numpy as np, pyarrow as pa
from linecraft.llm import _words
from linecraft.llm.fm_index import WORD
line = (" ".join(f"w{i % 5003}x" for i in range(60000)) + "\\n").encode()
data = line * (int(sys.argv[1]) // len(line))
text = pa.Array.from_buffers(pa.large_string(), 1, [None, pa.py_buffer(np.array([0, len(data)], np.int64)), pa.py_buffer(data)])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
h, _ = _words.shingles_of(_words.words_of(text, WORD), 2)
print(len(h), (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""


def test_a_text_of_200_mb_fits():
    out = subprocess.run([sys.executable, "-c", CHILD, str(200 << 20)], capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) < 10100  # few distinct pairs
    assert int(out[1]) < 1000, out
