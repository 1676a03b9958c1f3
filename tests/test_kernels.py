from hypothesis import given, settings
from hypothesis import strategies as st

from corpusflow.functions import kernels as K
from corpusflow.operators.alignment import Settings, align_document, clean_with_places
from corpusflow.operators.sequences import combined

WORDS = st.text("abc ", max_size=12)


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def plain_best_score(a, b, match=100, mismatch=-100, gap=-100):
    f = [[gap * (i + j) if not (i and j) else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    best = 0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            f[i][j] = max(0, f[i - 1][j - 1] + (match if a[i - 1] == b[j - 1] else mismatch), f[i][j - 1] + gap, f[i - 1][j] + gap)
            best = max(best, f[i][j])
    return best


@given(WORDS, WORDS)
@settings(max_examples=200, deadline=None)
def test_edit_distance(a, b):
    assert K.edit_distance(a, b) == plain_distance(a, b)
    ops = K.edit_operations(a, b)
    assert sum(o != "C" for _, _, o in ops) == plain_distance(a, b)
    assert "".join(r for r, _, _ in ops if r is not None) == a
    assert "".join(h for _, h, _ in ops if h is not None) == b


@given(st.text("ab ", min_size=1, max_size=8), st.text("ab ", min_size=1, max_size=20))
@settings(max_examples=200, deadline=None)
def test_local_alignment_score(a, b):
    start, end, score, _ = K.local_align(a, b, 0, len(b))
    assert 0 <= start <= end <= len(b)
    assert round(score * 100 * max(end - start, len(a))) == plain_best_score(a, b)


def test_equal_texts_align_fully():
    assert K.local_align("hello world", "hello world", 0, 11)[:3] == (0, 11, 1.0)


@given(WORDS, WORDS)
@settings(max_examples=100, deadline=None)
def test_similarities_are_shares(a, b):
    for name, f in K.SIMILARITIES.items():
        assert -1e-9 <= f(a, b) <= 1 + 1e-9, name
        if a.strip():
            assert abs(f(a, a) - 1) < 1e-9, name


def test_known_similarities():
    assert round(K.jaro_winkler("MARTHA", "MARHTA"), 4) == 0.9611
    assert K.mra_codex("Catherine") == "CTHRN"
    assert K.editex("neil", "niall") == 2 or K.editex("neil", "niall") == 1


@given(st.lists(st.text("abcd", min_size=1, max_size=5), min_size=1, max_size=6, unique=True), st.lists(st.text("abcd", min_size=1, max_size=5), min_size=1, max_size=6, unique=True))
@settings(max_examples=100, deadline=None)
def test_matching_is_stable(left, right):
    pairs = K.stable_match(left, right, plain_distance)
    assert len(pairs) == min(len(left), len(right))
    a, b = dict(pairs), {r: x for x, r in pairs}
    assert len(a) == len(b) == len(pairs)
    for x in left:
        for r in right:
            if a.get(x) != r:
                d = plain_distance(x, r)
                x_wants = x not in a or (d, r) < (plain_distance(x, a[x]), a[x])
                r_wants = r not in b or (d, x) < (plain_distance(b[r], r), b[r])
                assert not (x_wants and r_wants)


@given(st.lists(st.integers(1, 30), min_size=1, max_size=10), st.integers(1, 40))
@settings(max_examples=300, deadline=None)
def test_combining(durations, least):
    """Pieces are neighbours in order, long enough wherever all together are, and no long piece is joined to a long one."""
    parts = combined([float(d) for d in durations], float(least))
    assert [k for a, b in parts for k in range(a, b)] == list(range(len(durations)))
    sums = [sum(durations[a:b]) for a, b in parts]
    assert len(parts) == 1 or min(sums) >= least
    if all(d >= least for d in durations):
        assert len(parts) == len(durations)
    if sum(durations) >= 3 * least + 3 * max(durations):
        assert len(parts) > 1


def test_combining_prefers_the_shorter_neighbour():
    assert combined([30, 2, 20], 10) == [(0, 1), (1, 3)] and combined([20, 2, 30], 10) == [(0, 2), (2, 3)]


@given(st.text("abc ", min_size=1, max_size=9), st.text("abc ", min_size=1, max_size=90), st.integers(0, 30), st.integers(1, 4))
@settings(max_examples=300, deadline=None)
def test_windows_hold_the_most_trigrams(query, text, start, candidates):
    """Against votes counted one by one."""
    index = K.FuzzyText(text, candidates=candidates)
    grams = lambda x: [f" {x} "[k : k + 3] for k in range(len(x))]
    end, votes, order = len(text), {}, []
    for g in grams(query):
        for at, h in enumerate(grams(text)):
            if g == h and start <= at <= end:
                k = at // len(query)
                votes[k] = votes.get(k, 0) + 1
                if k not in order:
                    order.append(k)
    want = sorted(order, key=lambda k: (-votes[k], order.index(k)))[:candidates]
    for k in range(1, len(want)):
        if votes[want[k]] < index.ratio * votes[want[k - 1]]:
            want = want[:k]
            break
    assert index.windows(query, start, end).tolist() == want


def test_alignment_finds_fragments_in_order():
    text = "It was the best of times, it was the worst of times; it was the age of wisdom - it was the age of foolishness."
    said = ["it was the best of times", "it was the wurst of times", "it was the age of foolishness"]
    out = align_document([{"start": i, "end": i + 1, "transcript": s} for i, s in enumerate(said)], text, Settings())
    assert [x["start"] for x in out] == [0, 1, 2]
    assert out[0]["cer"] == 0 and 0 < out[1]["cer"] < 10
    assert text[out[0]["text_start"] : out[0]["text_end"]].lower().startswith("it was the best")
    assert align_document([{"start": 0, "end": 1, "transcript": "x"}], "", Settings()) == []


def test_cleaning_keeps_places():
    clean, places = clean_with_places("A  b-C!", Settings())
    assert clean == "a b c" and [("A  b-C!"[p]).lower() for p in places] == ["a", " ", "b", "-", "c"]


def test_sample_size():
    assert K.sample_size(0) == 0 and K.sample_size(10**9) == 16640


def test_spoken_english():
    assert K.spoken("It cost $1,250.50 on the 21st, not 3.14 or -7.") == "It cost one thousand two hundred fifty dollars and fifty cents on the twenty-first, not three point one four or minus seven."
    assert K.spoken("£1.01 and €3 for the 12th\n and  100th") == "one pound and one penny and three euros for the twelfth and one hundredth"
    assert K.spoken("v1.2.3 a5 5a") == "v1.2.3 a5 5a" and K.number_words(1_000_001) == "one million one" and K.number_words(0) == "zero"
    assert K.ordinal_words(20) == "twentieth" and K.ordinal_words(103) == "one hundred third"


def plain_repetitions(hyps, kinds):
    kinds, out = list(kinds), []
    for size in (2, 1):
        for i in range(len(hyps)):
            k, h = kinds[i : i + 2 * size], hyps[i : i + 2 * size]
            if len(h) == 2 * size and h[:size] == h[size:] and (size == 1 or h[0] != h[1]) and k in (["cor"] * size + ["ins"] * size, ["ins"] * size + ["cor"] * size):
                out += [i + n for n in range(2 * size) if k[n] == "ins"]
                kinds[i : i + 2 * size] = [None] * (2 * size)
    return sorted(out)


@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from(["cor", "ins", "sub"])), max_size=12))
@settings(max_examples=300, deadline=None)
def test_repetitions(rows):
    hyps, kinds = [h for h, _ in rows], [k for _, k in rows]
    assert K.repeated(hyps, kinds) == plain_repetitions(hyps, kinds)


@given(st.lists(st.integers(1, 50), min_size=1, max_size=20), st.integers(1, 5))
@settings(max_examples=200, deadline=None)
def test_balanced_parts(counts, parts):
    if parts > len(counts):
        return
    dealt = K.balanced(counts, parts)
    assert dealt == sorted(dealt) and len(dealt) == len(counts)
    size = [sum(c for c, p in zip(counts, dealt, strict=True) if p == k) for k in range(parts)]
    for k in range(parts - 1):
        own, after = [c for c, p in zip(counts, dealt, strict=True) if p == k], [c for c, p in zip(counts, dealt, strict=True) if p == k + 1]
        apart = abs(size[k + 1] - size[k])
        if own:
            assert abs(size[k + 1] - size[k] + 2 * own[-1]) >= apart
        if after:
            assert abs(size[k + 1] - size[k] - 2 * after[0]) >= apart


def test_lowest_by_halving():
    asked = []
    assert K.lowest(0, 100, lambda x: asked.append(x) or abs(x - 37)) == (37, 0) and len(asked) == len(set(asked)) < 10


def test_snapped_ends():
    text = "it was the best of times it was the worst of times"
    said = ["it was the best of times", "it was the worst of times"]
    whole = [(0, 24), (25, 50)]
    assert K.snapped(said, [(0, 22), (27, 50)], text) == whole and K.snapped(said, whole, text) == whole
    assert K.snapped([], [], text) == []
    # places that a plain search over both ends finds, for one fragment alone
    start, end = 11, 15
    word = lambda p: 1.5 if text[p : p + 1] == " " else 1.0
    best = max(range(end, end + 1), key=lambda p: word(p) * K.SIMILARITIES["wng"]("best", text[start:p]))
    assert K.snapped(["best"], [(start, end)], text)[0][1] == best


def test_snapped_alignment():
    text = "It was the best of times, it was the worst of times"
    said = ["it was the best of tim", "t was the worst of times"]
    plain, snap = (align_document([{"start": i, "end": i + 1, "transcript": s} for i, s in enumerate(said)], text, Settings(snap=k)) for k in (False, True))
    assert [x["hypothesis"] for x in plain] == said and [x["label"] for x in snap] == ["it was the best of times", "it was the worst of times"]
