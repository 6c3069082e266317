import random

import pytest

from tamis.llm import forms, langid, leakage, lookalike, overlap, pairs, pii
from tamis.llm.dictionaries import Dictionaries

MSG = "array<struct<role:string,content:string>>"


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [
        ("café", "café", True), ("ａｂｃ１", "abc1", True), ("la​mp", "lamp", True), ("a b", "a b", True), ("а", "a", True), ("أ", "أ", True), ("ﻻ", "لا", True), ("الریف", "الريف", True), ("٣alla9", "3alla9", True),
        ("بَّ", "بَّ", True), ("x​́", "x́", True), ("كتاب ک", "كتاب ك", True),
        ("café", "cafe", False), ("أ", "ا", False), ("A", "a", False), ("a  b", "a b", False), ("a.", "a", False), ("a\n", "a ", False), ("👨‍👩", "👨👩", False), ("برشّا", "برشا", False),
    ],
)
def test_canonical(a, b, same):
    assert (forms.canonical(a) == forms.canonical(b)) is same
    assert forms.canonical(forms.canonical(a)) == forms.canonical(a)


def test_composed_and_decomposed_spellings_meet():
    import unicodedata

    wrong = []
    for c in range(0x30000):
        x = chr(c)
        if 0xD800 <= c < 0xE000 or (d := unicodedata.normalize("NFD", x)) == x:
            continue
        form = forms.canonical(f"a{x}b")
        if not (form == forms.canonical(f"a{d}b") == forms.canonical(form)):
            wrong.append(hex(c))
    assert wrong == []
    rng = random.Random(1)
    marks = "\u0301\u0308\u0323\u0327\u064b\u0651\u0654\u05b0\u3099\u1161\u11a8"
    for _ in range(20_000):
        t = "".join(rng.choice("aеο ا\u0647یᄀかكk\u200b1" + marks * 2) for _ in range(rng.randrange(1, 8)))
        form = forms.canonical(t)
        assert form == forms.canonical(form) == forms.canonical(unicodedata.normalize("NFD", t)) == forms.canonical(unicodedata.normalize("NFC", t)), ascii(t)


def records(spark, rows):
    return spark.createDataFrame(rows, f"line_no long, split string, messages {MSG}, language string, source string")


def test_lookalike_pairs(spark):
    u = lambda t: [("user", t), ("assistant", None)]
    rows = [(1, "a", u("café x"), "fr", "s"), (2, "a", u("café x"), "fr", "s"), (3, "a", u("café x"), "fr", "s"), (4, "a", u("cafe x"), "fr", "s"), (5, "a", None, None, None), (6, "a", [], None, None), (7, "a", [("system", "café x"), ("assistant", None)], "fr", "s"), (8, "a", u(""), None, None), (9, "a", u("​"), None, None)]
    df = records(spark, rows)
    assert {(r["line_a"], r["line_b"]) for r in lookalike.lookalike_pairs(df).collect()} == {(1, 2), (2, 3), (8, 9)}
    classes = {r["line_no"]: tuple(r)[1:] for r in lookalike.lookalike_classes(df).collect()}
    assert classes == {1: (1, 1, 2), 2: (1, 2, 2), 3: (1, 1, 2), 8: (8, 8, 2), 9: (8, 9, 2)}
    forms_ = {r["line_no"]: r["messages"] for r in lookalike.canonical_messages(df).collect()}
    assert forms_[5] is None and forms_[6] == [] and forms_[2][0]["content"] == "café x" and forms_[1][1]["content"] is None
    assert lookalike.lookalike_pairs(df.limit(0)).count() == 0


def test_overlap_against_brute_force(spark):
    rng = random.Random(7)
    base = [[f"w{rng.randrange(300)}" for _ in range(50)] for _ in range(60)]
    rows, n = [], 0
    for b in base:
        for split in ("train", rng.choice(["val", "test"])):
            c = list(b)
            for _ in range(rng.choice([0, 0, 2, 4, 9])):
                c[rng.randrange(50)] = "new" + str(rng.randrange(1000))
            rows.append((n, split, [("user", " ".join(c[:20]).upper()), ("system", "noise " * n), ("assistant", ", ".join(c[20:]))], "en", "s"))
            n += 1
    rows += [(900, "train", None, None, None), (901, "test", [], None, None), (902, None, [("user", "x")], None, None), (903, "test", [("user", "?")], None, None), (904, "train", [("user", "!")], None, None)]
    sets = {r[0]: (r[1], forms.word_set([c for role, c in (r[2] or []) if role != "system"])) for r in rows}
    want = {(e, t) for e, (s, a) in sets.items() if s in ("val", "test") for t, (q, b) in sets.items() if q == "train" and a and b and len(a & b) >= 0.8 * len(a | b)}
    got = {(r["evaluation"], r["train"]) for r in overlap.cross_split_pairs(records(spark, rows)).collect()}
    assert len(want) > 20 and got == want
    classes = {r["line_no"]: tuple(r)[1:] for r in overlap.overlap_classes(records(spark, rows)).collect()}
    assert set(classes) == {x for pair in want for x in pair}
    least = {k: min(n for n, (q, w) in sets.items() if w == sets[k][1] and (q == "train") == (sets[k][0] == "train")) for k in classes}
    near = lambda k: {frozenset(sets[y if x == k else x][1]) for x, y in want if k in (x, y)}
    assert all(c[:3] == (sets[k][0] == "train", least[k], len(near(k))) and c[3] >= 0.8 for k, c in classes.items())
    catalog = spark.createDataFrame([("s",)], "source string")
    assert sum(r["overlapping"] for r in overlap.overlap_report(records(spark, rows), catalog).collect()) == len({e for e, _ in want})
    assert overlap.cross_split_pairs(records(spark, rows).limit(0)).count() == 0


def test_overlap_at_the_border(spark):
    rows = []
    for n in range(2000):  # eight common words of ten, none shared with another pair
        common = " ".join(f"c{n}x{i}" for i in range(8))
        rows += [(2 * n, "train", [("user", f"{common} left{n}")], "en", "s"), (2 * n + 1, "test", [("user", f"{common} right{n}")], "en", "s")]
    got = {(r["evaluation"], r["train"]) for r in overlap.cross_split_pairs(records(spark, rows)).collect()}
    assert got <= {(2 * n + 1, 2 * n) for n in range(2000)}
    assert len(got) >= 1994  # 0.14 % are missed on average


FR = ["Le chat de ma voisine mange une souris dans le jardin de la maison", "Je voudrais acheter du pain et des fruits pour le repas de ce soir", "Notre équipe prépare le rapport avec la directrice demain matin"]
EN = ["The neighbour bought a bicycle near the station and left for the market", "I would like to know when the meeting with the teacher will start", "Our team prepared the report with the manager yesterday morning"]
AZ = ["el-7anouti sakker el-7anout w mcha l dar m3a khouya elbera7", "chkoun jeb el-khobz mta3 el-3arssa ba7dha el-sou9 el-youm", "3lech el-karhba mta3 jarna mkassra w mawjouda fi el-zan9a"]
AR = ["البارح مشيت للسوق مع خويا وشرينا برشة غلّة", "علاش الكرهبة متاع جارنا واقفة قدّام الدار اليوم"]


LABELLED = [(k, ". ".join(v)) for k, v in (("fr", FR), ("en", EN), ("arabizi", AZ), ("ar", AR)) for _ in range(5)]


@pytest.fixture(scope="module")
def profiles():
    return langid.fit_texts(LABELLED)


@pytest.fixture(scope="module")
def dictionaries():
    return Dictionaries(LABELLED)


def test_dictionaries(dictionaries):
    assert [dictionaries.classify(x.lower())[0] for x in (FR[0], EN[0], AZ[0], AR[0], "xyzzy", "12", "")] == ["fr", "en", "arabizi", "ar", None, None, None]
    assert Dictionaries([]).classify("le chat") == (None, 0.0)


def test_languages(profiles):
    assert set(langid.text_languages([FR[0] + ". " + EN[0] + "."], profiles)) == {"fr", "en"}
    assert set(langid.text_languages([AR[0] + " le pain " + AR[1]], profiles)) == {"ar"}
    assert set(langid.text_languages([AR[0] + " " + FR[1]], profiles)) == {"ar", "fr"}
    assert langid.text_languages([None, "", "123 !"], profiles) == {}
    assert profiles.classify(AZ[0].lower())[0] == "arabizi"


def test_relabelled(spark, profiles):
    rows = [(1, "t", [("user", FR[0])], "fr-TN", "s"), (2, "t", [("user", EN[0])], "?", "s"), (3, "t", [("user", AZ[0]), ("assistant", FR[0])], "ar", "s"), (4, "t", [("user", FR[0] + "\n" + AR[0])], "mixed", "s"), (5, "t", [("user", None)], None, None), (6, "t", None, None, None)]
    got = {r["line_no"]: (r["label"], r["right"], [x["lang"] for x in r["languages"]]) for r in langid.relabelled(records(spark, rows), profiles).collect()}
    assert got == {1: ("fr", "fr", ["fr"]), 2: (None, "en", ["en"]), 3: ("ar", "arabizi", ["arabizi"]), 4: ("mixed", "mixed", ["ar", "fr"]), 5: (None, None, [])}
    assert langid.relabelled(records(spark, rows).limit(0), profiles).count() == 0


def test_profiles_read_records_whole(spark):
    rows = [(n, "t", [("user", (FR[0] + ". ") * 30), ("assistant", " ".join(["zwqk zwqk zwqk zwqk."] * 200))], "fr", "s") for n in range(3)]
    ranked = langid.fit(records(spark, rows)).ranked["fr"]
    assert langid.gram_ids("zwqk")[1] in ranked and set(langid.gram_ids("zwqk").tolist()) <= set(ranked.tolist())


def test_arabic_goes_through_the_distance(profiles):
    d = profiles.distances(AR[0])
    assert 0.0 < d["ar"] < 1.0 and d["fr"] == d["en"] == 1.0
    assert profiles.classify(AR[0]) == ("ar", 1.0 - d["ar"]) and profiles.classify(AR[0] + " merci")[0] == "ar"
    assert langid.Profiles({"fr": FR}).classify(AR[0]) == (None, 0.0)


def test_short_sentences(spark, profiles):
    assert "ar" in langid.text_languages(["Bonjour madame. شكرا ليك."], profiles) and len(langid.text_languages(["Bonjour madame. شكرا ليك."], profiles)) == 2
    assert set(langid.text_languages([FR[0] + ". شكرا ليك."], profiles)) == {"fr", "ar"} and set(langid.text_languages([FR[0] + ". شكرا."], profiles)) == {"fr"}
    rows = [(1, "t", [("user", FR[0] + ". Oui madame. 12. شكرا."), ("assistant", "Non.")], "fr", "s")]
    got = sorted((r["turn"], r["segment"], r["text"]) for r in langid.segments(records(spark, rows), profiles).collect())
    assert got == [(0, 0, FR[0].lower()), (0, 1, "oui madame"), (0, 2, "شكرا")]


def test_defects(spark, dictionaries):
    endings = pairs.Endings([f"{x}. {y}." for x in FR + EN for y in FR + EN] * 3)
    d = lambda q, a: pairs.defect(q, a, dictionaries, endings)
    q = "Pourquoi le chat de ma voisine mange une souris dans le jardin ?"
    assert [d(q, a) for a in (None, "", "​ ", "N/A", "null", "—")] == ["empty_answer"] * 6
    assert d(q, q) == d(q, "Vous dites : " + q.upper()) == "copied_question"
    assert d(q, "Désolé, je ne peux pas répondre à cette question. Je ne suis qu'un programme.") == "refusal"
    assert d(q, FR[1] + ". Il a dit « je ne peux pas vous aider », puis il a trouvé.") is None
    assert d(q, "Oui, exactement.") is None and d(q, FR[1] + ". " + FR[2]) is None
    assert d(q, EN[0] + ". " + EN[2] + ".") == "other_language"
    assert d("Réponds en anglais : " + q, EN[0] + ". " + EN[2] + ".") is None
    for cut in (FR[1] + ". Notre équipe prépare le", FR[1] + ". (le chat", FR[1] + ". «", "Voici :", f"1. {FR[1]}.\n2.", FR[1] + ".\n```python\nprint(1)"):
        assert d(q, cut) == "truncated_answer", cut
    excuse = "Désolé, cela est contraire aux règles que suit ce programme dans tous les cas de ce genre et pour tout le monde. "
    assert len(excuse) > 100 and d(q, "Je ne peux pas répondre à cette question. " + excuse * 8) == "refusal"
    assert d(q, "Merci beaucoup pour cette belle question que vous me posez ce matin, mais je ne peux pas y répondre.") == "refusal"
    assert d(q, "I cannot help you with that because it concerns the private data of a person who has not agreed to have it shared with anybody at all.") == "refusal"
    assert d(q, "Je ne peux pas le jurer, mais " + FR[0] + ". " + FR[1] + ".") is None
    assert d(q, "unknown" + " " * 30) == "empty_answer" and d(q, " [ N/A ] ") == "empty_answer"
    assert d(q, f"{q} {q}") == d(q, f"{q} {q} {q} {q}") == "copied_question" and d(q, q + " " + ". ".join(FR[1:]) + ".") is None
    assert d(FR[0] + ". " + EN[0] + ".", EN[1] + ".") is None and d(FR[0] + ".", "Merci.") is None
    rows = [(1, "t", [("user", q), ("assistant", None), ("user", q), ("assistant", FR[1] + ".")], "fr", "s"), (2, "t", None, None, None), (3, "t", [("assistant", "")], None, None)]
    got = [(r["line_no"], r["turn"], r["defect"]) for r in pairs.defective_pairs(records(spark, rows), dictionaries=dictionaries, endings=endings).collect()]
    assert got == [(1, 1, "empty_answer")]


def test_sentence_ends_count_all_answers(spark, dictionaries):
    rng = random.Random(3)
    vocabulary = [f"{a}{b}" for a in ("mot", "kal", "ser", "12") for b in range(60)]
    weights = [1 / (1 + i) ** 1.2 for i in range(len(vocabulary))]
    rows = []
    for n in range(9000):  # more than any sample that was taken before
        said = [rng.choices(vocabulary, weights, k=4) + (["zarbout"] if n % 1800 == 7 else []) + rng.choices(("fin", "rare" + str(n % 4000)), (6, 1)) for _ in range(2)]
        answer = ". ".join(" ".join(s) for s in said) + rng.choice([".", " " + rng.choice(vocabulary), ". Encore zarbout", " " + str(n), ". Seul" + str(n)])
        rows.append((n, "t", [("user", "xx yy zz"), ("assistant", answer)], "fr", "s"))
    endings = pairs.Endings([forms.canonical(r[2][1][1]) for r in rows])
    df = records(spark, rows)
    told = lambda **x: sorted(map(tuple, pairs.defective_pairs(df, dictionaries=dictionaries, **x).collect()))
    got = told()
    assert got == told(endings=endings) and 1000 < len(got) < 8000
    # ten uses and never an end
    assert {n for n, _, *_ in rows if rows[n][2][1][1].endswith("Encore zarbout")} <= {n for n, _, d in got if d == "truncated_answer"}


def test_scarce_word_is_no_sentence_end():
    endings = pairs.Endings(["Ils mangent toujours des pommes. Elles aiment dormir."] * 50 + ["Voici presque toutes les pommes."] * 5)
    assert not endings.may_end(["voici", "presque"]) and endings.may_end(["les", "pommes"])


def test_leaks_against_brute_force(spark):
    rng = random.Random(4)
    items = [(i, " ".join(f"v{rng.randrange(60)}" for _ in range(40)), None if i % 3 else "") for i in range(12)] + [(50, "too short", None), (51, None, None)]
    items.append((60, items[0][1], None))
    docs = []
    for n in range(80):
        w = [f"v{rng.randrange(60)}" for _ in range(60)]
        if n % 2:
            src = rng.choice(items[:12])[1].split()
            k = rng.choice([13, 14, 15, 16, 25])
            o = rng.randrange(0, 40 - k)
            p = [x.upper() + "," for x in src[o : o + k]]
            if n % 5 == 0:
                p[k // 2] = "zz"
            w[20:20] = p
        docs.append((n, "  ".join(w), "clash"))
    docs += [(100, None, "x"), (101, "", "x")]
    d = spark.createDataFrame(docs, "doc_id long, text string, item string")
    i = spark.createDataFrame(items, "item_id long, prompt string, expected_behavior string")
    grams = {}
    for k, t, _ in items:
        w = forms.words(t)
        for x in range(len(w) - 14):
            grams.setdefault(tuple(w[x : x + 15]), set()).add(k)
    want = {(n, k) for n, t, _ in docs for w in [forms.words(t)] for x in range(len(w) - 14) for k in grams.get(tuple(w[x : x + 15]), ())}
    found = leakage.find_leaks(d, i).collect()
    assert {(r["doc_id"], r["item"]) for r in found if r["edits"] == 0} == want and len(want) > 10
    blocks = leakage.find_leaks(d, i, block_words=100).collect()
    assert sorted(map(tuple, blocks)) == sorted(map(tuple, found))
    assert leakage.find_leaks(d.limit(0), i).count() == 0 and leakage.find_leaks(d, i.limit(0)).count() == 0


def test_edited_passage_is_found(spark):
    w = [f"u{i}" for i in range(15)]
    changed = w[:7] + ["other"] + w[8:]
    d = spark.createDataFrame([(1, " ".join(["a", *changed, "b"])), (2, " ".join(w[:7] + ["o", "p"] + w[9:]))], "doc_id long, text string")
    i = spark.createDataFrame([(9, " ".join(w), None)], "item_id long, prompt string, expected_behavior string")
    assert [tuple(r) for r in leakage.find_leaks(d, i).collect()] == [(1, 9, 1)]


def test_every_edit_of_every_window_is_found():
    index = leakage.Index([(9, [f"u{i}" for i in range(35)])])
    for start in range(21):
        w = list(range(start + 1, start + 16))
        for at in range(15):
            for edited in (w[:at] + [0] + w[at + 1 :], w[:at] + w[at + 1 :], w[:at] + [0] + w[at:]):
                found = index.search([[0, 0, *edited, 0, 0]])
                assert [x[:2] for x in found] == [(0, 9)] and found[0][2] <= 1, (start, at, edited)


def levenshtein_ends(p, t):
    row = [0] * (len(t) + 1)
    for i, x in enumerate(p, 1):
        new = [i]
        for j, y in enumerate(t, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[1:]


def test_myers_against_table():
    rng = random.Random(9)
    for _ in range(300):
        p, t = ([rng.randrange(4) for _ in range(rng.randrange(1, 20))] for _ in range(2))
        assert leakage.myers_ends(p, t, 99) == levenshtein_ends(p, t)


@pytest.mark.parametrize("m", [1, 15, 63, 70])
def test_myers_of_many_rows_against_table(m):
    import numpy as np

    rng = random.Random(m)
    patterns = [[rng.randrange(1, 4) for _ in range(m)] for _ in range(60)]
    texts = [[x if rng.random() < 0.9 else 0 for x in p][rng.randrange(3) :] + [0] * rng.randrange(3) for p in patterns]
    filled = np.array([t + [-1] * (m + 4 - len(t)) for t in texts])
    want = [min([*levenshtein_ends(p, t), m]) for p, t in zip(patterns, texts)]
    for budget in (99, 2):
        assert leakage.myers_least(np.array(patterns), filled, budget).tolist() == [min(x, budget + 1) for x in want]


def test_personal_information(spark):
    given, family = frozenset({"slim", "rim"}), frozenset({"borganine", "ben tarfoul", "مسمدّي"})
    text = "Write to slim.b@mail.example, rim (at) box[dot]test or ana @ mx.invalid. Call +216 61-161 779 or Tél. 06 39 98 98 23. CIN : 05597333. Order 20258047 is late on 2025-04-16. Signed, Slim Borganine | BEN TARFOUL Rim, 24, rue du Puits Vert, 5952 Sfax. Slim left. @derja_3 v1.2.3"
    got = [(text[a:b], k) for a, b, k in pii.detect(text, given, family)]
    assert got == [
        ("slim.b@mail.example", "email"), ("rim (at) box[dot]test", "email"), ("ana @ mx.invalid", "email"), ("+216 61-161 779", "phone"), ("06 39 98 98 23", "phone"),
        ("05597333", "id_number"), ("Slim Borganine", "name"), ("BEN TARFOUL Rim", "name"), ("24, rue du Puits Vert, 5952 Sfax", "address"),
    ]
    odd = "tel ＋216 ٦١ ٤٢١ ٧٢٨ sl​im＠box.test"
    assert [(odd[a:b], k) for a, b, k in pii.detect(odd, given, family)][-1] == ("sl​im＠box.test", "email")
    assert pii.detect(None) == [] and pii.detect("") == [] and len(pii.detect("a@b.cd " * 3000)) == 3000
    docs = spark.createDataFrame([(1, "Signed, Slim Borganine. Hier, Rim Borganine a écrit."), (2, "si Slim Borganine, Rim Khaledi et Slim Khaledi"), (3, None), (4, ""), (4, "x@y.zz"), (4, "x@y.zz")], "doc_id long, text string")
    names = spark.createDataFrame([("Slim", "latin"), ("Rim", "latin"), (None, None)], "name string, script string")
    rows = sorted(map(tuple, pii.find_pii(docs, names).collect()))
    assert rows == [(1, "name", "Rim Borganine"), (1, "name", "Slim Borganine"), (2, "name", "Rim Khaledi"), (2, "name", "Slim Borganine"), (2, "name", "Slim Khaledi"), (4, "email", "x@y.zz"), (4, "email", "x@y.zz")]
    red = {r["redacted"] for r in pii.find_pii(docs, names, redact=True).collect()}
    assert red >= {None, "", "[EMAIL]", "Signed, [NAME]. Hier, [NAME] a écrit."}
    assert pii.find_pii(docs.limit(0), names.limit(0)).count() == 0


def test_hints_let_through_what_patterns_take():
    given, family = frozenset({"slim"}), frozenset({"borganine"})
    kinds = lambda text: [(text[a:b], k) for a, b, k in pii.detect(text, given, family)]
    for sep in (" ", ", ", "-", ".", " - "):
        for said in (["five", "two", "three", "four", "six", "seven", "eight", "nine"], ["two"] * 8, ["خمسة", "ستّة", "ثلاثة", "أربعة", "ستّة", "سبعة", "ثمانية", "تسعة"]):
            number = sep.join(said)
            assert kinds(f"Tel: {number} !") == [(number, "phone")], number
    for before in ("(", "«", "**", ":", "_ ", "[", "x/"):
        for street in ("rue du Puits n° 4, 5952 Sfax", "شارع الحرية عدد 7, صفاقس"):
            assert kinds(f"{before}{street})") == [(street, "address")], before + street
    assert kinds("12, zan9et el-bhar, Sfax") == [("12, zan9et el-bhar, Sfax", "address")]
    for text in ("**Slim Borganine**", "Nom:Slim Borganine", "_Slim Borganine_", "1.Slim Borganine/x", "`Slim Borganine`", "#Slim Borganine"):
        assert kinds(text) == [("Slim Borganine", "name")], text


def test_names_are_learned_inside_markup(spark):
    docs = spark.createDataFrame([(1, "**Slim Borganine** et **Rim Borganine**"), (2, "Nom:Slim Borganine")], "doc_id long, text string")
    names = spark.createDataFrame([("Slim", "latin"), ("Rim", "latin")], "name string, script string")
    assert {(r["doc_id"], r["found"]) for r in pii.find_pii(docs, names).collect()} == {(1, "Slim Borganine"), (1, "Rim Borganine"), (2, "Slim Borganine")}


def test_pieces_of_words_are_no_names(spark):
    docs = spark.createDataFrame([(1, "Slim Borganine, Rim Borganine. Slim el-7anout, Rim el-9ahwa, Slim b3id, Rim b3id w Slim el- 7anout"), (2, "El-9ahwa, b3id El-7anout")], "doc_id long, text string")
    names = spark.createDataFrame([("Slim", "latin"), ("Rim", "latin")], "name string, script string")
    given, family = (sorted(r[0] for r in x.collect()) for x in pii.lexicon(docs, names))
    assert (given, family) == (["rim", "slim"], ["borganine"])


def test_any_number_of_names(spark, monkeypatch):
    docs = spark.createDataFrame([(n, t) for n, t in enumerate(["Slim Borganine, Rim Borganine, Slim Khaledi, Rim Khaledi, Slim Ben Mzoughi, Rim ben Mzoughi", "Hedi Khaledi et HEDI Borganine", None, "", "Slim Borganine", "Slim Borganine"])], "doc_id long, text string")
    names = spark.createDataFrame([("Slim", "latin"), ("Rim", "latin")], "name string, script string")
    found = lambda: sorted(map(tuple, pii.find_pii(docs, names).collect()))
    want = found()
    assert len(want) == 10 and (1, "name", "HEDI Borganine") in want
    for most in (3, 1, 0):  # the lexicons are too large for a broadcast
        monkeypatch.setattr(pii, "MAX_NAMES", most)
        assert found() == want


def test_quick_looks_lose_nothing():
    rng = random.Random(8)
    given, family = frozenset({"slim", "rim"}), frozenset({"borganine", "ben tarfoul"})
    parts = ["rue", "12", "24,", "n°", "4", "Sfax", "Lyon", ",", ".", " ", " ", " ", "\n", "five", "two", "khamsa", "deux", "-", "(", ")", "+216", "00216", "61 161 779", "20258047", "X12345", "passport", "CIN", ":", "tel", "a", "@", "(at)", "[dot]", "b.cd", "dot", "at", "Slim", "Borganine", "BEN", "Tarfoul", "«", "**", "_", "شارع", "عدد", "٣", "street", "order", "is", "|", "0", "9"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) + rng.choice(("", " ")) for _ in range(rng.randrange(2, 24)))
        assert pii.detect(text, given, family) == pii.detect(text, given, family, quick=False), text


def test_long_texts_take_no_longer_than_their_length(dictionaries):
    import time

    began = time.process_time()
    for piece in ("12345678 ", "place ", "12 rue ", "passport ", "tel ", "a@b.cd ", "five ", "rue n° 4 ", "(at) ", "1.", "Slim "):
        pii.detect(piece * (40_000 // len(piece)), frozenset({"slim"}), frozenset({"borganine"}))
    for piece in (" ", "\n", ".", "!", "?!", "1. ", "\u064e", "\u0301", "- ", "``` ", "( ", "désolé ", "je ne peux pas "):
        pairs.judge("Pourquoi ?", "x" + piece * (40_000 // len(piece)) + "y", dictionaries)
    assert time.process_time() - began < 20


def test_ends_of_answers():
    assert [pairs.ends_in_marker(x) for x in ("a.\n2.", "1)", "a. -", "a.\n\n  •", "a 12.", "le 3.", "a - b", "a.-", "dit: 3)")] == [True, True, True, True, False, False, False, False, False]
    assert pairs.tail_off("a 😀 \n☀️") == "a" and pairs.tail_off(" ") == "" and pairs.complete_sentences("a b... c d?! e") == [["a", "b"], ["c", "d"]]


def test_long_and_odd_personal_information():
    kinds = lambda text: [(text[a:b], k) for a, b, k in pii.detect(text)]
    long = "24, rue du Puits Vert derrière la grande mosquée et le vieux marché aux poissons séchés, 5952 Sfax"
    assert kinds(f"J'habite {long}.") == [(long, "address")]
    assert kinds("Voici: 24, rue du Puits Vert, Lyon.") == [("24, rue du Puits Vert, Lyon", "address")]
    assert kinds("Adresse:12 Green Well Street, 4021 Port Blue") == [("12 Green Well Street, 4021 Port Blue", "address")]
    assert kinds("passport: X12345") == [("X12345", "id_number")] and kinds("My passport is 05597333") == [("05597333", "id_number")]
    assert kinds("Le passeport que la préfecture de la ville m'a enfin remis hier soir a le 05597333.") == [("05597333", "id_number")]
    assert kinds("24 places. 12 rue, puis 13.") == [] and kinds("passport, order 20258047") == []
