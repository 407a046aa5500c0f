"""Quality rules (4), pseudonyms (5), language identification (6) and language-model scores (7)."""

import collections
import datetime
import hashlib
import hmac
import itertools
import math
import re
import time
import zlib

import numpy as np
import pytest

from tideweave.llm import decisions, langid, lm, pii, quality

from .conftest import sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    """The base rules by their definition."""
    text = text or ""
    words, seen, repeated = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    windows = collections.Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    n, r = len(words), len(covered)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, r, n < 50 or 100 * r > 50 * n


def labelled(spark, rng, n=160):
    good = [sentence(rng, 70) for _ in range(n)]
    junk = [" ".join(w + rng.choice(("###", "$$$", "%%%")) for w in sentence(rng, 70).split()) for _ in range(n // 4)]
    docs = [(i, t) for i, t in enumerate(good + junk)]
    labels = [(i, int(i < n), 0) for i, _ in docs if i % 2]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), n


def test_quality_rules_and_verdict(spark, rng, odd, empty):
    docs, labels, n = labelled(spark, rng)
    model = quality.train(docs, labels)
    rows = quality.quality(docs, model).collect()
    for r, d in zip(sorted(rows, key=lambda r: r.doc_id), docs.orderBy("doc_id").collect(), strict=True):
        assert tuple(r)[1:7] == base(d.text)
        assert r.kept == (not r.base_failed and r.quality_p >= 0.5)
    held = [r for r in rows if r.doc_id % 2 == 0]
    assert sum((r.quality_p >= 0.5) == (r.doc_id < n) for r in held) >= 0.97 * len(held)
    odd_rows = quality.quality(odd, model).collect()
    assert sorted(str(tuple(r)[:7]) for r in odd_rows) == sorted(str((d.doc_id, *base(d.text))) for d in odd.collect())
    assert quality.quality(empty, model).count() == 0 and quality.keep_good(empty, model).columns == empty.columns
    assert {r.doc_id for r in quality.keep_good(docs, model).collect()} == {r.doc_id for r in rows if r.kept}
    assert quality.train(docs, labels.where("quality = 1")) is None
    assert all(r.kept != r.base_failed for r in quality.quality(docs, None).collect())


def test_quality_score_is_the_models(rng):
    texts = [sentence(rng, 30) for _ in range(40)]
    model = quality.fit(texts, [i % 2 for i in range(40)])
    words = quality.Words(model)
    for t, numbers in zip(texts, words.numbers([t.encode().split() for t in texts]), strict=True):
        index, value = quality._features(t)
        assert abs(model.margin(numbers, words) - model.bias - model.weights[index] @ value) < 1e-5


def test_repeated_words_beyond_packed_numbers(rng):
    numbers = np.array([rng.randint(0, 6) for _ in range(200)])
    assert quality.repeated_words(numbers) == quality.repeated_words(numbers + (1 << 22)) == base(" ".join(map(str, numbers)))[4]


def test_permutations_are_one_to_one(spark):
    for size in (2, 10, 97, 1000):
        rows = spark.range(size).select(pii.permute(pii.F.col("id"), size, "k", "t").alias("p")).collect()
        assert sorted(r.p for r in rows) == list(range(size))
    codes = [f"{a}{b}{c}" for a in "ab" for b in "xyz" for c in "019"]
    rows = spark.createDataFrame([(c,) for c in codes], "c string").select(pii.permute_text(pii.F.col("c"), "k", "t").alias("p")).collect()
    assert len({r.p for r in rows}) == len(codes) and all(re.fullmatch("[a-z][a-z][0-9]", r.p) for r in rows)


def luhn(digits):
    total = sum(sum(divmod(int(d) * (2 if i % 2 else 1), 10)) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def test_pseudonyms(spark, odd, empty):
    texts = [
        "pay 4111 1111 1111 1111 or 4111111111111111, not 4111111111111112",
        "write jo.doe7@mail.example.com, call +1 (476) 555-6291; again jo.doe7@mail.example.com",
        "from 152.143.123.131, not 300.1.1.1",
        "ssn 123-45-6789, not 000-45-6789",
        "on 2024-02-29 and 31/12/1999, not 2023-02-30 or 1492-01-01",
        'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"',
        "to DE89 3704 0044 0532 0130 00 AND THAT or GB82WEST12345698765432, not GB83WEST12345698765432; call 476-555-6291",
        "nothing of the kind in 12 words, 3.5 % of all",
        None,
    ]
    rows = pii.pseudonymise(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "k").orderBy("doc_id").collect()
    for text, row in zip(texts, rows, strict=True):
        if text is None or text.startswith("nothing"):
            assert row.text == text and not row.changed
        else:
            # Only the kinds of characters that were there, in the same places.
            assert re.sub(r"\d", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", row.text))) == re.sub(r"\d", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", text))) or row.n_ip or row.n_secret
            assert row.text != text and row.changed
    spaced, plain = re.findall(r"\d{4} \d{4} \d{4} \d{4}|\d{16}", rows[0].text)[:2]
    assert spaced.replace(" ", "") == plain and luhn(plain) and "4111111111111112" in rows[0].text
    mails = re.findall(r"\S+@\S+", rows[1].text)
    assert mails[0].strip(",") == mails[1] and mails[1].endswith("@mail.example.com") and "+1 (" in rows[1].text
    assert "300.1.1.1" in rows[2].text and "000-45-6789" in rows[3].text and "1492-01-01" in rows[4].text and "2023-02-30" in rows[4].text
    assert re.search(r'"[0-9a-f]{40}"', rows[5].text)
    codes = re.findall(r"[A-Z]{2}\d\d(?:[A-Z0-9]{18}|[A-Z0-9 ]{21}\d\d?)", rows[6].text)
    sums = [int("".join(str(int(c, 36)) for c in (x[4:] + x[:4]))) % 97 for x in (y.replace(" ", "") for y in codes)]
    assert sums[:2] == [1, 1] and codes[2].startswith("GB83WEST1234") and codes[0].startswith("DE") and (rows[6].n_iban, rows[6].n_phone) == (2, 1)
    assert pii.pseudonymise(odd, "k").count() == odd.count() and pii.pseudonymise(empty, "k").count() == 0


def test_pseudonyms_of_cards_beside_other_numbers_and_of_plain_phones(spark):
    card = "4111 1111 1111 1111"
    texts = [f"{card} 05/27", "4111111111111111 123", f"12 {card}", f"123 456 {card} 99", f"{card} 5500 0000 0000 0004", f"{card} 12/05/2027", f"{card} 10.20.30.40"]
    texts += ["call 1-202-555-0143", "call 202 555 0143 now", "call 202-555-0143", "no 4111 1111 1111 1112 here"]
    rows = pii.pseudonymise(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "k").orderBy("doc_id").collect()
    assert [r.n_card for r in rows] == [1, 1, 1, 1, 2, 1, 1, 0, 0, 0, 0]
    assert [(r.n_phone, r.n_date, r.n_ip) for r in rows] == [(0, 0, 0)] * 5 + [(0, 1, 0), (0, 0, 1)] + [(1, 0, 0)] * 3 + [(0, 0, 0)]
    plain = lambda r: re.sub(r"\D", "", r.text)
    alone = plain(rows[4])[:16]
    assert luhn(alone) and alone != "4111111111111111" and luhn(plain(rows[4])[16:]) and plain(rows[4])[16:] != "5500000000000004"
    assert plain(rows[0]) == alone + "0527" and plain(rows[1]) == alone + "123" and plain(rows[2]) == "12" + alone and plain(rows[3]) == "123456" + alone + "99"
    assert rows[7].text.startswith("call 1-") and rows[7].text != texts[7] and rows[8].text != texts[8]
    assert rows[10].text == texts[10] and not rows[10].changed
    assert plain(rows[7])[1:] == plain(rows[8]) == plain(rows[9])


def mac(kind, turn, half):
    return hmac.new(b"k", f"{kind}\x1f{turn}\x1f{half}".encode(), "sha256").hexdigest()


def feistel(left, right, a, b, kind):
    for i in range(8):
        if i % 2 == 0:
            left = (left + int(mac(kind, i, right)[:15], 16)) % a
        else:
            right = (right + int(mac(kind, i, left)[:15], 16)) % b
    return left, right


def digits_brute(text, kind):
    n = len(text)
    m = (n + 1) // 2
    left, right = feistel(int(text[:m]), int(text[m:]), 10**m, 10 ** (n - m), f"{kind}{n}")
    return f"{left:0{m}d}{right:0{n - m}d}"


def text_brute(text, kind, classes):
    halves = [text[: len(text) // 2], text[len(text) // 2 :]]
    for i in range(8):
        digest, out = mac(kind, i, halves[1 - i % 2]), ""
        for at, c in enumerate(halves[i % 2]):
            by = int(hashlib.sha256(f"{digest}{at}".encode()).hexdigest()[:8], 16)
            alphabet = next((x for x in classes if c in x), None)
            out += alphabet[(alphabet.index(c) + by) % len(alphabet)] if alphabet else c
        halves[i % 2] = out
    return "".join(halves)


def test_pseudonyms_equal_a_plain_feistel(spark, rng):
    number = lambda n: "".join(rng.choices("0123456789", k=n))
    texts, want = [], []
    for n in range(13, 20):
        body = number(n - 1)
        check = lambda x: x + next(c for c in "0123456789" if luhn(x + c))
        texts.append(check(body))
        want.append(check(digits_brute(body, "card")))
    for _ in range(6):
        area, rest = rng.choice("2345"), number(9)
        texts.append(f"{area}{rest[:2]}-{rest[2:5]}-{rest[5:]}")
        new = digits_brute(area + rest, "phone")
        want.append(f"{new[:3]}-{new[3:6]}-{new[6:]}")
        ip = rng.randrange(1 << 32)
        left, right = feistel(ip >> 16, ip & 0xFFFF, 1 << 16, 1 << 16, "ip")
        texts.append(".".join(str(b) for b in ip.to_bytes(4, "big")))
        want.append(".".join(str(b) for b in (left << 16 | right).to_bytes(4, "big")))
        first, day = datetime.date(1900, 1, 1), rng.randrange(pii.DAYS)
        texts.append(str(first + datetime.timedelta(day)))
        a, b = 271, 270
        while True:
            left, right = feistel(day // b, day % b, a, b, "date")
            day = left * b + right
            if day < pii.DAYS:
                break
        want.append(str(first + datetime.timedelta(day)))
        local = "".join(rng.choices("abcXYZ019._", k=rng.randint(1, 12))) + "e"
        texts.append(f"{local}@example.org")
        want.append(text_brute(local, "email", pii.CLASSES) + "@example.org")
    rows = pii.pseudonymise(spark.createDataFrame([(i, f"see {t} there") for i, t in enumerate(texts)], "doc_id long, text string"), "k").orderBy("doc_id").collect()
    assert [r.text for r in rows] == [f"see {w} there" for w in want]


def test_pseudonyms_take_time_in_proportion_to_the_text(spark):
    texts = ["a" * 1_000_000, "1" * 1_000_000, "a@" * 200_000, "a.b-" * 200_000, "4111 1111 1111 1111 " * 5_000, "x@a.b " * 20_000]
    began = time.time()
    rows = pii.pseudonymise(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "k").orderBy("doc_id").collect()
    assert [len(r.text) for r in rows] == list(map(len, texts)) and [r.changed for r in rows] == [False, False, False, False, True, False]
    assert time.time() - began < 60
    with pytest.raises(ValueError):
        pii.pseudonymise(spark.range(1), "")


def tongue(rng, sounds, n):
    return " ".join("".join(rng.choices(sounds, k=rng.randint(1, 4))) for _ in range(n))


def test_language_of_documents_and_of_mixed_text(spark, rng, odd, empty):
    sounds = {"xa": ["th", "er", "in", "wh"], "xb": ["eau", "oi", "é", "ch"], "xc": ["sch", "ung", "ei", "ü"]}
    docs = [(i, tongue(rng, sounds[g], rng.randint(5, 60)), g) for i, g in enumerate(rng.choices(list(sounds), k=240))]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    crf = langid.train(df)
    rows = {r.doc_id: r for r in langid.identify(df, crf).collect()}
    for i, _, _ in docs:
        assert rows[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= rows[i].score <= 1
    held = [(rows[i].lang_pred, g) for i, _, g in docs if rows[i].held_out]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    mixed = langid.label_words(tongue(rng, sounds["xa"], 20) + " " + tongue(rng, sounds["xb"], 20), crf)
    right = sum(g == "xa" for _, g, _ in mixed[:20]) + sum(g == "xb" for _, g, _ in mixed[20:])
    assert right >= 36
    odd_rows = {(r.doc_id, r.lang_pred == "und", r.score == 0) for r in langid.identify(odd, crf).collect()}
    assert {(1, True, True), (2, True, True), (4, True, True), (3, False, False)} <= odd_rows
    assert langid.identify(empty, crf).count() == 0 and langid.train(empty) is None
    assert {r.lang_pred for r in langid.identify(odd, None).collect()} == {"und"}


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(3)
    e, moves = rng.random((5, 3, 4)) + 0.1, rng.random((4, 4)) + 0.1
    lengths = [5, 3, 1]
    alive = np.array([sum(n > t for n in lengths) for t in range(5)])
    found, _ = langid.forward_backward(e, moves, alive)
    for d, n in enumerate(lengths):
        want = np.zeros((n, 4))
        for path in itertools.product(range(4), repeat=n):
            p = np.prod([e[t, d, k] for t, k in enumerate(path)]) * np.prod([moves[a, b] for a, b in itertools.pairwise(path)])
            for t, k in enumerate(path):
                want[t, k] += p
        assert np.allclose(found[:n, d], want / want.sum(axis=1, keepdims=True))


def test_language_model_counts_and_base_scores(spark, rng, odd, empty):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(i, sentence(rng, rng.randint(0, 80)).title()) for i in range(150)]
    for df in (spark.createDataFrame(docs, "doc_id long, text string").repartition(3), odd, empty):
        data = [(r.doc_id, [*WORD.findall((r.text or "").translate(lower)), None]) for r in df.collect()]
        taught = lambda key: zlib.crc32(str("null" if key is None else key).encode()) % 5 != 1
        counts = collections.Counter(t for key, tokens in data if taught(key) for t in tokens)
        n = sum(counts.values())
        per = lambda t: math.log10((counts[t] + 0.5) / (n + 0.5 * (len(counts) + 1)))  # noqa: B023, E731
        want = sorted((str(k), not taught(k), len(ts), sum(counts[t] > 0 for t in ts), n, round(sum(map(per, ts)), 6)) for k, ts in data)
        rows = lm.score(df).collect()
        found = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)
        assert found == want and all(r.score < 0 and r.bits_per_byte > 0 for r in rows)


def test_token_probabilities_form_a_distribution():
    """The code's symbols at one place share probability 1, whatever was learned."""
    rng = np.random.default_rng(5)
    code = lm.huffman(rng.integers(0, 1000, lm.SYMBOLS))
    counters = rng.integers(0, 1 << 16, lm.OFFSETS[-1]).astype(np.uint16)
    mixer = lm.Mixer(rng.normal(0, 0.4, (lm.GATES, lm.K)), rng.random((lm.GATES, lm.RATES, 2)) * 9)
    # The first symbol of a one-byte token is that byte: its share is the product over the byte's path alone.
    total = 10 ** lm.log10_probabilities([None], code, counters, mixer)[0]
    for byte in set(range(256)) - {lm.MARK}:
        data = [bytes([byte])]
        share = np.ones(1)
        symbols_seen = 0
        for owner, bit, slots in lm.steps(data, code):
            first = np.arange(len(owner)) == 0 if symbols_seen < code.lengths[byte] else np.zeros(len(owner), bool)
            odds, gate = lm._inputs(counters, slots, None)
            x = lm._mixed(odds, gate, mixer.weights)
            refined = ((mixer.rates[:, :, 1] + lm.RATE_PRIOR * lm.CENTRES) / (mixer.rates.sum(axis=2) + lm.RATE_PRIOR)).ravel()
            p = 0.5 / (1 + np.exp(-x)) + 0.5 * refined[gate * lm.RATES + lm._bucket(x)]
            share *= np.where(bit, p, 1 - p)[first].prod()
            symbols_seen += 1
        total += share[0]
    mark = 1 - total  # what is left for an empty word, which never occurs
    assert -1e-9 < mark < 1


def test_language_model_learns(spark, rng):
    docs = [(i, sentence(rng, 60)) for i in range(400)] + [(i, "".join(rng.choices("qxzjk ", k=300))) for i in range(400, 410)]
    rows = {r.doc_id: r for r in lm.score(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    usual = [r.bits_per_byte for k, r in rows.items() if k < 400 and r.held_out]
    assert np.mean(usual) < 3 and min(rows[k].bits_per_byte for k in range(400, 410) if rows[k].held_out) > np.mean(usual)


def test_language_model_knows_word_order(spark, rng):
    words = sorted({"".join(rng.choices("abcdefgh", k=5)) for _ in range(60)})
    follow = {w: rng.sample(words, 2) for w in words}

    def fluent(n):
        out = [rng.choice(words)]
        while len(out) < n:
            out.append(rng.choice(follow[out[-1]]))
        return out

    docs, pairs = [(i, " ".join(fluent(60))) for i in range(300)], []
    held = [i for i in range(1000, 1400) if zlib.crc32(str(i).encode()) % 5 == 1][:60]
    for a, b in zip(held[::2], held[1::2], strict=True):
        text = fluent(60)
        docs += [(a, " ".join(text)), (b, " ".join(rng.sample(text, len(text))))]
        pairs.append((a, b))
    rows = {r.doc_id: r for r in lm.score(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    assert all(rows[a].score > rows[b].score + 20 for a, b in pairs)
    assert all(abs(rows[a].base_score - rows[b].base_score) < 1e-6 for a, b in pairs)
    assert all(rows[a].score > rows[a].base_score for a, _ in pairs)


def test_language_model_counts_of_pairs_and_triples(spark, rng):
    docs = [(i, [rng.choice("abc") for _ in range(rng.randint(0, 12))]) for i in range(60)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string").repartition(3)
    rows = {r.doc_id: r for r in lm.score(df).collect()}
    taught = [w for i, w in docs if not rows[i].held_out]
    grams = collections.Counter()
    for w in taught:
        w = [None, None, *w, "END"]
        for i in range(2, len(w)):
            grams.update([(w[i],), tuple(w[i - 1 : i + 1]), tuple(w[i - 2 : i + 1])])
    total = sum(n for g, n in grams.items() if len(g) == 1)
    learn = decisions.Mixer.new()
    learn.weights += np.random.default_rng(1).normal(0, 0.2, learn.weights.shape)
    # Whatever the context, what may follow shares probability 1 at most.
    for u, v in [(None, None), (None, "a"), ("a", "b"), ("c", "c")]:
        before = [x for x in (u, v) if x]
        share = new = 0.0
        for w in ("a", "b", "c", "END", "new"):
            text = [None, None, *before, w]
            counts = [np.array([grams[tuple(text[i - n : i + 1])] for i in range(2, len(text))]) for n in range(3)]
            places = decisions.Places(*counts, np.arange(len(text) - 2), len(taught), total, np.zeros(len(text) - 2))
            p = 10 ** learn.log10_probabilities(places)[-1]
            share, new = share + (0 if places.new[-1] else p), p if places.new[-1] else new
        assert 0 < new and 0.2 < share + new <= 1 + 1e-9
    assert rows[docs[0][0]].train_tokens == total


def test_decisions_equal_a_plain_mixer(rng):
    """Scores and what is learned, against one place at a time in Python."""
    rand = np.random.default_rng(3)
    lengths = [1, 7, 2, 30, 1, 19]
    place = np.concatenate([np.arange(n) for n in lengths])
    c1 = rand.integers(0, 6, len(place))
    c2 = np.minimum(rand.integers(0, 4, len(place)), c1)
    c3 = np.minimum(rand.integers(0, 3, len(place)), c2)
    train = np.repeat([True, False, True, True, False, True], lengths)
    c1, c2, c3 = (np.maximum(c, train) for c in (c1, c2, c3))
    places = decisions.Places(c1, c2, c3, place, 4, 200, train)
    learn = decisions.Mixer.new()
    learn.learn(lambda give, size: give(places).ravel())

    q = lambda n: sum(n >= s for s in decisions.STEPS)
    asked, level = [], []
    for i in range(len(place)):
        less = int(train[i])
        one, two = (4, 4) if place[i] == 0 else (c1[i - 1], c2[i - 1])
        one, two, total = max(one - less, 0), max(two - less, 0), 200 - less
        counts = [c3[i] - less, c2[i] - less, c1[i] - less]
        of = [two, one, total]
        yes = next((d for d in range(3) if counts[d] > 0 and of[d] > 0), 3)
        level.append(3 - yes)
        last = [level[i - n] if place[i] >= n else 0 for n in range(9)]
        run = next((n for n in range(place[i]) if level[i - 1 - n] != 3), place[i])
        run = min(run, 31)
        seen = q(two) * 10 + q(one)
        three = max(c3[i - 1] - int(train[i - 1]), 0) if place[i] else 0
        pairs = last[1] * 4 + last[2]
        contexts = [sum((last[n] == 3) << n - 1 for n in range(1, 9)), pairs * 100 + seen, (last[3] * 16 + pairs) * 10 + q(one), q(three) * 32 + run]
        asked.append([(d, yes == d, contexts, q(two) if d == 0 else q(one)) for d in range(min(yes, 2) + 1) if of[d] > 0])
        share = counts[yes] / of[yes] if yes < 3 else 1
        asked[-1].append(min(share, 1))
    seen = collections.Counter()
    for i, (*bits, _) in enumerate(asked):
        seen.update((d, k, c, y) for d, y, contexts, _ in bits for k, c in enumerate(contexts) if train[i])
    for i, (*bits, share) in enumerate(asked):
        want = math.log10(share)
        for d, y, contexts, gate in bits:
            n = lambda k, c, bit: seen[d, k, c, bit] - (train[i] and y == bit) + 0.4  # noqa: B023, E731
            x = [math.log(n(k, c, True) / n(k, c, False)) for k, c in enumerate(contexts)] + [0.3]
            at = round((max(-8, min(8, sum(x[:-1]) / len(x[:-1]))) + 8) * 2)
            x = max(-8, min(8, sum(a * b for a, b in zip(x, learn.weights[d, gate], strict=True))))
            rates = learn.rates[d, gate, at]
            refined = (rates[1] + 8 / (1 + math.exp(8 - at / 2))) / (rates.sum() + 8)
            p = 0.5 / (1 + math.exp(-x)) + 0.5 * refined
            want += math.log10(p if y else 1 - p)
        assert abs(learn.log10_probabilities(places)[i] - want) < 1e-9
    assert learn.counts.sum() == sum(len(bits) for i, (*bits, _) in enumerate(asked) if train[i]) * decisions.CONTEXTS


def test_scores_do_not_depend_on_partitions(spark, rng):
    docs = [(i, sentence(rng, rng.randint(0, 50))) for i in range(300)]
    docs += [(1000 + i, docs[i][1]) for i in range(0, 300, 9)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    a, b = ({r.doc_id: r for r in lm.score(df.repartition(n)).collect()} for n in (1, 7))
    assert all(abs(a[k].score - b[k].score) < 1e-6 and abs(a[k].score_unseen - b[k].score_unseen) < 1e-6 for k, _ in docs)
    assert all(r.score == pytest.approx(r.score_unseen) for r in a.values() if r.held_out)
    twice = {i for i in range(0, 300, 9)} | {1000 + i for i in range(0, 300, 9)}
    per = lambda k: a[k].score_unseen / a[k].n_tokens
    assert np.median([per(k) for k, t in docs if k in twice and len(t) > 100]) > np.median([per(k) for k, t in docs if k not in twice and len(t) > 100]) + 0.5
