import itertools
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import frame
from tillwise.llm import langid, quality, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def larger(llm):
    return llm.read.parquet(f"{SF}/documents.parquet"), llm.read.parquet(f"{SF}/labels.parquet")


def accuracy(scored, labels, column):
    rows = scored.where("held_out").join(labels, "doc_id").select("predicted", column, "score").collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    return np.mean([r["predicted"] == r[column] for r in rows])


def same_rows(scored, docs):
    assert sorted((r[0] for r in scored.select("doc_id").collect()), key=repr) == sorted((r["doc_id"] for r in docs.collect()), key=repr)


def test_quality(larger, edges, nothing):
    docs, labels = larger
    assert accuracy(quality.score(docs, labels), labels, "quality") >= 0.95
    bad = labels.select("doc_id", F.lit(None).cast("int").alias("quality"))
    same_rows(quality.score(edges, bad), edges)
    assert quality.score(nothing, labels).collect() == []


def test_quality_gradients():
    r = np.random.default_rng(0)
    model = quality.Attention.new(1, 0.5)
    model.w = {k: v.astype(float) for k, v in model.w.items()}
    x, starts, y, weight = r.normal(size=(9, quality.FEATURES)), np.array([0, 4, 5]), np.array([1.0, 0, 1]), np.array([1.0, 2, 1])

    def loss():
        p = model.forward(x, starts)[-1]
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / len(y)

    found = model.gradients(x, starts, y, weight)
    for name in model.w:
        at = tuple(r.integers(0, n) for n in model.w[name].shape)
        keep = model.w[name][at]
        model.w[name][at] = keep + 1e-5
        up = loss()
        model.w[name][at] = keep - 1e-5
        assert found[name][at] == pytest.approx((up - loss()) / 2e-5, abs=1e-5)
        model.w[name][at] = keep


def test_passages_hold_the_whole_text():
    for text in ("", "a", "é" * 3000, "word " * 5000, "x" * 5000 + " y"):
        assert b"".join(quality.passages(text)) == text.encode()
    assert quality.encode(None).shape == (1, quality.FEATURES)


def test_known_words_of_a_very_long_text():
    """All words before a passage count as known, however many they are."""
    words = [f"{k:x}" for k in range(1_100_000)]
    found = quality.encode(" ".join(words + words[-20_000:]))[:, -3]
    assert found[-1] == 1 and found[:100].max() == 0
    text = "a b c a b d " * 300
    seen = set()
    for part, share in zip(quality.passages(text), quality.encode(text)[:, -3], strict=True):
        own = set(part.split())
        assert share == pytest.approx(len(own & seen) / len(own))
        seen |= own


@pytest.fixture(scope="module")
def fitted(larger):
    return toxicity.fit(*larger)


def test_toxicity(larger, edges, nothing):
    docs, labels = larger
    assert accuracy(toxicity.score(docs, labels), labels, "toxic") >= 0.92  # 40 toxic documents to learn from
    same_rows(toxicity.score(edges, labels.where("false")), edges)
    assert toxicity.score(nothing, labels).collect() == []


def test_hidden_words_are_restored(fitted):
    restorer = fitted.restorer
    for hidden, word in (("1d10t", "idiot"), ("m0r0n!", "moron"), ("l0s3r", "loser"), ("cl0wn,", "clown"), ("$tup1d", "stupid"),
                         ("P4thetic", "pathetic"), ("looooser", "loser"), ("iidiiiot", "idiot"), ("m*ron", "moron")):
        assert word in restorer.words(hidden), hidden
    assert "idiot" in restorer.text_words("you i d i o t you")
    assert "moron" in restorer.text_words("a m.o.r.o.n here") + restorer.text_words("m o r o n")
    assert restorer.words("Plain,") == ["plain"]
    plain = fitted.score("the thing is there and the other thing was there too")
    hidden = fitted.score("the thing is 1d10t and the m0r0n thing was $tup1d there too")
    assert plain < 0.5 < hidden
    assert fitted.score(None) == fitted.score("") < 0.5


def test_every_ambiguous_chunk_is_decoded(fitted):
    """A letter doubled once, signs without a letter or at an edge, and gaps of any white space or marks."""
    restorer = fitted.restorer
    for hidden, word in (("mooron", "moron"), ("iidiot", "idiot"), ("!diot", "idiot"), ("(lown", "clown")):
        assert word in restorer.words(hidden), hidden
    decoded = []
    plain = restorer.decode
    restorer.decode = lambda token, spaced=False: decoded.append(token) or plain(token, spaced)
    try:
        for chunk in ("10$3", "$$", "hello", "one"):
            restorer.words(chunk)
    finally:
        restorer.decode = plain
    assert decoded == ["10$3", "$$", "hello"]
    assert "hello" in restorer.words("Hello,")  # letters stay a reading of their own
    for text in ("you i  d  i  o  t you", "i\td\ti\to\tt", "an (i d i o t) here", "i. d. i. o. t.", "i - d - i - o - t", '"i\nd i  o t"'):
        assert "idiot" in restorer.text_words(text), text


def test_decoding_is_the_best_path(fitted):
    """A wide beam is an exhaustive search on a short token."""
    restorer, model = fitted.restorer, fitted.restorer.model
    for token in ("m0r0n", "1d1", "aaab"):
        best = None
        for path in itertools.product(*(restorer._options(token, k, False) for k in range(len(token)))):
            state, out, cost = b"   ", b"", sum(c for _, c in path)
            for byte in "".join(e for e, _ in path).encode():
                if byte == 32 and state[-1] == 32:
                    continue
                cost += model.cost(state, byte)
                state, out = state[1:] + bytes([byte]), out + bytes([byte])
            cost += 0 if state[-1] == 32 else model.cost(state, 32)
            best = min(best or (cost, out), (cost, out))
        assert restorer.decode(token) == best[1].decode().strip()


def test_grams_are_counted_exactly(llm):
    """Many distinct grams; none shares its count with another, none spans two texts, and counts don't depend on the partitions."""
    r = np.random.default_rng(3)
    texts = ["".join(map(chr, r.integers(0x100, 0x3000, 30_000))) + " end" for _ in range(4)] + [None, "", "a", "A\0b", "end", "start"]
    docs = frame(llm, [(k, t, "en", "a") for k, t in enumerate(texts)])
    want = Counter()
    for text in texts:
        if text is not None:
            data = toxicity._normal(text.encode()).tobytes()
            want.update(data[k:k + n] for n in (1, 2, 3, 4) for k in range(len(data) - n + 1))
    assert len(want) > 100_000
    models = [toxicity.CharModel.learn(docs.repartition(n, "doc_id")) for n in (2, 7)]
    for model in models:
        assert [g for g, n in want.items() if model._count(g) != n] == []
        assert model._count(b"zzzz") == model._count(b"q z") == model._count(b"d st") == 0
    assert all(np.array_equal(a, b) for a, b in zip(*((m.grams, m.numbers) for m in models), strict=True))


def test_no_state_is_lost(llm):
    """Where the best path starts among many dearer ones, all states count."""
    def exhaustive(token):
        best = {b"   ": (0.0, b"")}
        for k in range(len(token)):
            after = {}
            for state, (cost, text) in best.items():
                for emitted, extra in restorer._options(token, k, False):
                    own, last, out = cost + extra, state, text
                    for byte in emitted.encode():
                        if byte == 32 and last[-1] == 32:
                            continue
                        own += model.cost(last, byte)
                        last, out = last[1:] + bytes([byte]), out + bytes([byte])
                    if last not in after or (own, out) < after[last]:
                        after[last] = (own, out)
            best = after
        return min((cost + (0 if last[-1] == 32 else model.cost(last, 32)), text) for last, (cost, text) in best.items())[1].decode().strip()

    words = "oaoz uiuq eaei iouo aeeu ueoa oioe " * 3 + "iueaz " * 6
    model = toxicity.CharModel.learn(frame(llm, [(1, words, "en", "a")]))
    restorer = toxicity.Restorer(model)
    tokens = ["".join(t) for n in (3, 4, 5) for t in itertools.product("*1z", repeat=n)] + ["*" * 40, "*1" * 20]
    assert [t for t in tokens if restorer.decode(t) != exhaustive(t)] == []
    assert restorer.decode("i" * 30_000)  # long chunks take linear time


def test_language(larger, edges, nothing):
    docs, _ = larger
    found = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) >= 0.98
    got = {r["doc_id"]: r for r in langid.identify(edges).collect()}
    assert all(got[k]["lang_pred"] == "und" and got[k]["score"] == 0 for k in (3, 4, 5, 6))
    assert got[7]["lang_pred"] in ("en", "fr", "de") and 0 <= got[7]["score"] <= 1
    assert langid.identify(nothing).collect() == []
    unnamed = frame(edges.sparkSession, [(1, "word", None, "a")])
    assert langid.identify(unnamed).first()["lang_pred"] == "und"
    kept = langid.keep_known(edges)
    assert kept.columns == edges.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 7, 7, 8, 9, 10]


def test_forward_sums_all_segmentations():
    pieces = ["a", "ab", "b", "ba", "▁", "▁a", "bab"]
    r = np.random.default_rng(0)
    p = r.dirichlet(np.ones(len(pieces)), size=2).T
    model = langid.Model(langid.Lattice(pieces), p)
    at = {piece: k for k, piece in enumerate(pieces)}

    def brute(word, lang):
        if not word:
            return 1.0
        total = 0.0
        for k in range(1, len(word) + 1):
            part = word[:k]
            if part in at:
                total += p[at[part], lang] * brute(word[k:], lang)
            elif k == 1:
                total += langid.UNSEEN * brute(word[1:], lang)
        return total

    words = ["▁abab", "▁b", "a", "▁babxab", "bbbbbb", "▁abbabababab"]
    scores = model.score(words)
    for word, row in zip(words, scores, strict=True):
        assert np.exp(row) == pytest.approx([brute(word, 0), brute(word, 1)])
    single = langid.Model(langid.Lattice(pieces), p[:, :1])
    counts = single.expected(["▁ab"], 0, np.array([3.0]))
    # expected characters covered add up to the word's
    assert sum(c * len(x) for c, x in zip(counts, pieces, strict=True)) == pytest.approx(9)


def test_long_runs_are_scored_whole():
    """Segmentations over any place of a long run count; sums in logarithms are those of plain products."""
    assert langid.words_of("x" * 200 + " y") == ["▁" + "x" * 200, "▁y"]
    pieces = ["a", "ab", "b", "ba", "▁", "▁a", "bab"]
    r = np.random.default_rng(0)
    p = r.dirichlet(np.ones(len(pieces)), size=2).T
    at = {piece: k for k, piece in enumerate(pieces)}

    def log_sum(word, lang):
        logs = [0.0]
        for j in range(1, len(word) + 1):
            ways = []
            for k in range(1, min(3, j) + 1):
                part = word[j - k:j]
                if part in at or k == 1:
                    ways.append(logs[j - k] + np.log(p[at[part], lang] if part in at else langid.UNSEEN))
            logs.append(np.logaddexp.reduce(ways))
        return logs[-1]

    words = ["▁" + "".join(r.choice(list("abx"), n)) for n in (3, 63, 64, 65, 200, 3000, 5)]
    model = langid.Model(langid.Lattice(pieces), p)
    assert np.allclose(model.score(words), [[log_sum(w, 0), log_sum(w, 1)] for w in words])
    single = langid.Model(langid.Lattice(pieces), p[:, :1])
    counts = single.expected(["▁" + "ab" * 100], 0, np.array([3.0]))
    assert sum(c * len(x) for c, x in zip(counts, pieces, strict=True)) == pytest.approx(603)
    assert list(langid.batches_of(["a" * 60_000] * 3 + ["b" * 300_000, "c"])) == [(0, 1), (1, 2), (2, 3), (3, 4), (4, 5)]
    assert list(langid.batches_of([])) == []


def test_readings_that_are_not_decoded_have_no_evidence():
    """The scorer decodes only what can spell a feature; a chunk's evidence is the same as over all decoded words."""
    import random

    r = random.Random(5)
    text = " ".join(r.choice(["moron", "idiot", "pass", "moment", "iris", "class", "zeal", "still", "boss"]) for _ in range(3000)).encode()
    grams = toxicity._grams(toxicity._normal(text))
    model = toxicity.CharModel(*toxicity._added(grams, np.ones(len(grams), dtype=np.int64)))
    evidence = {"=moron": 3.0, "^idio": 2.0, "=bo": 1.7, "^claa": 2.5, "=zealot": 4.0}
    scorer = toxicity.Scorer(model, evidence, np.zeros(toxicity.Scorer.SIZE))
    alphabet = "moridtbclsaze0135!|$@*-é7."
    chunks = ["moron", "m0r0n", "mooron!", "1d10t", "iidiots", "b0ss", "cla@s", "cl@a", "zeal0t", "z3al0tt", "bo-", "(bo)", "100", "b0", "0", "!!", "claass"]
    chunks += ["".join(r.choice(alphabet) for _ in range(r.randint(1, 8))) for _ in range(3000)]
    plain = toxicity.Restorer(model)
    skipped = 0
    for chunk in chunks:
        want = max(0.0, scorer._words(plain.words(chunk)))
        assert max(0.0, scorer._chunk(chunk)) == want, chunk
        skipped += not scorer._can_matter(chunk.lower())
    assert skipped > len(chunks) / 2
