"""Blocks of pages: all words count, deep nesting stays linear, training bounds are parameters."""

import time
import tracemalloc

import numpy as np

from tessera.llm import html_extract as H


def test_words_after_the_fiftieth_count():
    words = [f"w{i}" for i in range(120)]
    pages = [f"<p>{' '.join(words)}</p>", f"<p>{' '.join(words[:110] + [f'v{i}' for i in range(10)])}</p>"]
    a, b = (H.block_vectors(H.leaf_blocks(p), {}, H.WordSlots())[0] for p in pages)
    assert (a[H.PATH_DIM : -4] != b[H.PATH_DIM : -4]).any() and np.abs(a).max() <= 3


def test_path_vectors_are_those_of_the_open_tags():
    page = "<html><body><div class='a b'><span><p id=x>one <b>two</b></p></span><ul><li>three<li>four</ul></div><nav>five</nav>six"
    blocks = H.leaf_blocks(page)
    assert [t for _, t, _ in blocks] == ["one two", "three", "four", "five", "six"]
    paths = [["html", "body", "div", ".a", ".b", "p", ".x"], *2 * [["html", "body", "div", ".a", ".b", "ul", "li"]], ["html", "body", "nav"], ["html", "body"]]
    for (path, _, _), words in zip(blocks, paths):
        want = np.zeros(H.PATH_DIM, np.float32)
        for w in words:
            i, sign = H._slot(w, H.PATH_DIM, {})
            want[i] = sign
        assert (path.hashed({}) == want).all()
    assert [b[0].around for b in blocks] == [False, False, False, True, False]


def test_deep_nesting_is_linear():
    times = []
    for n in (2_500, 10_000):
        for page in ("<div>x" * n, "<li>x<ul>" * n, "<dt><div>x<dd>" * (n // 2)):
            tracemalloc.start()
            at = time.process_time()
            blocks = H.leaf_blocks(page)
            x = H.block_vectors(blocks, {}, H.WordSlots())
            times.append(time.process_time() - at)
            peak = tracemalloc.get_traced_memory()[1]
            tracemalloc.stop()
            assert len(x) >= n // 2 and peak < 4000 * n
    assert sum(times[3:]) < 12 * sum(times[:3])


def test_training_bounds_are_parameters():
    page = "<body><article>" + "".join(f"<p>main {i}</p>" for i in range(100)) + "</article><footer>" + "".join(f"<p>foot {i}</p>" for i in range(50)) + "</footer>"
    xs, ys = H.training_pages([page], rounds=1)
    assert len(xs[0]) == 150 and ys[0].sum() == 100
    xs, ys = H.training_pages([page], rounds=1, max_steps=40, max_main=10)
    assert len(xs[0]) == 40 and ys[0].tolist() == [True] * 20 + [False] * 20 and ys[1].sum() <= 10
