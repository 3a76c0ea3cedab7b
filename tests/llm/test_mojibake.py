import pytest

from bitloom.llm import mojibake

LINES = {
    "de": "// Überschreibt den größeren Ausschnitt für spätere Läufe während der Prüfung",
    "fr": "# Déplace à côté l’élément précédent après échec répété à la fin de l’étape",
    "ru": "// Проверяет сначала соседний узел если хватает памяти",
    "ja": "// 後で削除する、最後の行を二回まで",
    "zh": "// 重新读取名称模板每次处理之后仅在失败时",
    "pl": "# Usuń później żółty wskaźnik dopóki trwa noc, ostatnią gałąź",
    "en": "keeps “as is” the writer’s offsets — £3 or €2 at ½ the rate, 5 µs",
}
CODE = "def f(x):\n    return x + 1  # plain\n"


def wrong(text, written, read, errors="strict"):
    return text.encode(written).decode(read, errors)


@pytest.fixture(scope="module")
def corpus():
    return [(1000 + i, CODE + line + f"\nx = {i}\n" + line[: 20 + i]) for i in range(30) for line in LINES.values()]


def found(spark, corpus, docs):
    rows = [(i, t, "x") for i, t in corpus + docs]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    return {r.doc_id: r.text for r in mojibake.mended_documents(df).collect()}


def test_repairs(spark, corpus):
    ways = [
        ("utf-8", "latin-1", LINES), ("utf-8", "mac_roman", ["de", "fr", "en"]), ("utf-8", "cp437", ["de", "fr"]), ("utf-8", "koi8_r", ["de", "fr"]), ("utf-8", "iso8859_15", ["de", "fr"]),
        ("cp1251", "latin-1", ["ru"]), ("koi8_r", "cp1251", ["ru"]), ("cp1252", "cp1251", ["de", "fr"]), ("cp1250", "cp1252", ["pl"]),
        ("gb18030", "latin-1", ["zh"]), ("euc_jp", "latin-1", ["ja"]), ("cp850", "latin-1", ["de"]), ("cp1252", "mac_roman", ["de"]), ("cp1252", "gbk", ["de"]),
    ]
    docs, want = [], {}
    for written, read, names in ways:
        for name in names:
            good = CODE + LINES[name] + "\n" + CODE
            docs.append((len(docs), CODE + wrong(LINES[name], written, read) + "\n" + CODE))
            want[docs[-1][0]] = good
    twice = wrong(wrong(LINES["fr"], "utf-8", "latin-1"), "utf-8", "latin-1")
    docs.append((900, CODE + twice + "\n" + twice))
    want[900] = CODE + LINES["fr"] + "\n" + LINES["fr"]
    docs.append((901, wrong(CODE + LINES["de"], "utf-16-le", "latin-1")))
    want[901] = CODE + LINES["de"]
    docs.append((902, wrong("﻿" + CODE, "utf-8", "cp1252")))
    want[902] = "﻿" + CODE
    got = found(spark, corpus, docs)
    assert {i for i in got if i < 1000} == set(want) and not any(i >= 1000 for i in got)
    assert {i: got[i] for i in want} == want


def test_any_number_of_layers(spark, corpus):
    docs, want = [], {}
    bad = LINES["de"]
    for i in range(1, 8):
        bad = wrong(bad, "utf-8", "latin-1")
        docs.append((i, CODE + bad))
        want[i] = CODE + LINES["de"]
    for i, ways in enumerate([("koi8_r", "cp1251", "cp866", "cp1251"), ("cp1251", "koi8_r", "cp866", "cp1251"), ("koi8_r", "cp1251", "koi8_r", "cp1251"), ("cp1251", "koi8_r", "cp1251", "koi8_r")]):
        docs.append((20 + i, CODE + wrong(wrong(LINES["ru"], *ways[:2]), *ways[2:]) + "\n# " + LINES["fr"]))
        want[20 + i] = CODE + LINES["ru"] + "\n# " + LINES["fr"]
    assert found(spark, corpus, docs) == want


def test_long_literals_are_literals_too(spark, corpus):
    quoted = "’àéî€" * 8
    assert found(spark, corpus, [(1, f'{{ "{wrong(quoted, "utf-8", "cp1252")}": "{quoted}" }}')]) == {}


def test_lost_signs_are_found_without_a_text(spark, corpus):
    docs = [(1, CODE + wrong(LINES["de"], "cp1252", "utf-8", "replace")), (2, CODE + wrong(LINES["ja"], "utf-8", "cp1252", "replace").replace("�", "?")), (3, CODE + LINES["fr"].replace("é", "�"))]
    assert {k: v for k, v in found(spark, corpus, docs).items()} == {1: None, 2: None, 3: None}


def test_correct_text_is_left_alone(spark, corpus):
    docs = [
        (1, None), (2, ""), (3, " \n\xa0\n"), (4, CODE),
        (5, "  { garbled: 'Ã‰', wanted: 'É' },\n  { garbled: 'â€œ', wanted: '“' },"),
        (6, 'REPAIRS = {\n    "Ã¼": "ü",\n    "Âµ": "µ",\n}'),
        (7, "pub const REPLACEMENT: char = '�';\nassert_eq!(decode(&[0xff]), \"�\");"),
        (8, "msg=Þetta er ógild slóð\nmsg=Đường dẫn không hợp lệ\nmsg=ATENÇÃO À MÃO\nmsg=أضف المفتاح"),
        (9, "╔════╗\n║█▓ ░║\n╚════╝"), (10, "# ∑α ∈ ℝ ⇒ β² ≤ 4·ω₀\n🌊🧭 done ✓ é ﬁn ①"),
        (11, "« état modifié » à « côté » „Ä“ É’"),
    ]
    assert found(spark, corpus, docs) == {}


def test_a_program_that_was_garbled_itself(spark, corpus):
    text = wrong("  { garbled: 'Ã‰', wanted: 'É' },\n  { garbled: 'Ã¼', wanted: 'ü' },", "utf-8", "cp1252")
    assert set(found(spark, corpus, [(1, text)])) == {1}


def test_repeats_long_texts_and_empty_tables(spark, corpus):
    garbled = CODE + wrong(LINES["de"], "utf-8", "latin-1")
    long = ("x = 1  # " + LINES["de"] + "\n") * 3000 + garbled
    got = found(spark, corpus, [(1, garbled), (1, garbled), (None, garbled), (2, long)])
    assert set(got) == {1, None, 2} and got[2].endswith(LINES["de"])
    assert found(spark, [], []) == {}


CZECH = "# nejdřív přečte řádek a příště uloží během dne"


def test_common_garbling_is_no_proof_of_itself(spark, corpus):
    bad, good = (CODE + line + "\n" + CODE for line in (wrong(CZECH, "cp1250", "cp1252"), CZECH))
    bads = [CODE + wrong(f"# řada {w} příště během řídký", "cp1250", "cp1252") for w in ("dne", "noci", "roku", "týdne", "léta")]
    rows = [(i, t, f"r{i % 40}") for i, t in corpus]
    rows += [(5000 + i, good.replace("dne", f"dne {i}"), f"r{i % 40}") for i in range(30)]
    # a third of the rows are copies, slightly changed in other lines too
    rows += [(i, bad if i % 2 else f"# {i}\n{bad}", f"r{i % 40}") for i in range(120)]
    rows += [(200 + i, bads[i % 5].replace("#", f"# {i}"), "giant") for i in range(40)]  # different texts of one repository
    df = spark.createDataFrame(rows, "doc_id bigint, text string, repo string").repartition(3)
    got = {r.doc_id: r.text for r in mojibake.mended_documents(df).collect()}
    assert set(got) == {*range(120), *range(200, 240)} and got[1] == good and got[0] == "# 0\n" + good
    known = corpus + [(5000 + i, good.replace("dne", f"dne {i}")) for i in range(30)]
    assert set(found(spark, known, [(i, bad) for i in range(120)])) == set(range(120))


@pytest.mark.parametrize("order", ["utf-16-le", "utf-16-be"])
def test_utf16_passages(spark, corpus, order):
    part = "entry 17: naïve café, ждёт ключ, 重新读取 end\n"
    lines = [f"value_{i} = {i}  # plain text Z\n" for i in range(400)]
    docs = {
        1: ([*lines, wrong(part, order, "latin-1")], [*lines, part]),  # one appended line of a long file
        2: ([*lines[:100], wrong(part, order, "latin-1"), *lines[100:], wrong(part, order, "latin-1")], [*lines[:100], part, *lines[100:], part]),
        3: ([*lines[:3], wrong(part * 4, order, "latin-1"), *lines[3:5]], [*lines[:3], part * 4, *lines[3:5]]),  # more than a tenth
        4: ([wrong(CODE + "x", order, "latin-1")[:-1] if order == "utf-16-le" else wrong(CODE, order, "latin-1")], [CODE + "x" if order == "utf-16-le" else CODE]),  # of odd length
        5: ([wrong(CODE + part * 3, order, "latin-1")], [CODE + part * 3]),
    }
    got = found(spark, corpus, [(i, "".join(bad)) for i, (bad, _) in docs.items()] + [(9, "a\x00b = 1\nc\x00 = 2\n")])
    assert got == {i: "".join(good) for i, (_, good) in docs.items()}
