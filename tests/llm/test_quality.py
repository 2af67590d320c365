from __future__ import annotations

from weatherloom.llm import quality

PROSE = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))


def plain(text):
    ws, lines = words(text), [x for x in (text or "").split("\n") if words(x)]
    grams = [tuple(ws[i : i + 3]) for i in range(len(ws) - 2)]
    hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    return (
        len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit),
        len(ws) < 50 or 100 * len(hit) > 50 * len(ws),
    )


def words(text):
    for space in "\t\n\x0b\x0c\r":
        text = (text or "").replace(space, " ")
    return [w for w in text.split(" ") if w] if text else []


def test_measures_of_edge_rows(documents):
    texts = [
        None, "", " \n\t ", "a", "a b c", "a b c a b c", "x y z " * 40, "one\n\n one\none\r\none\none", PROSE, PROSE,
        "##é# $a|b", "same line\nsame line\nSame line", "long " * 30_000 + PROSE,
    ]
    df = documents([(i if i % 5 else None, t) for i, t in enumerate(texts)]).selectExpr("*", "1 as host", "2 as n_words", "3 as h")
    rows = quality.verdicts(df).collect()
    got = sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows)
    assert got == sorted(plain(t) for t in texts)
    assert all(r.kept == (not r.base_failed) for r in rows)


def test_empty(documents):
    assert quality.verdicts(documents([])).collect() == []
    assert quality.apply_rules(documents([]), clean=True).collect() == []


def test_frequent_lines_of_a_host(documents):
    """A line over the limit on one host goes, in any case and with any digits; on another it stays."""
    menu = "Home News 12 About"
    rows = [(i, f"{PROSE} {i}\nhome news {i % 10}{i % 7} ABOUT", None, "a") for i in range(25)]
    rows += [(100 + i, f"{PROSE} b{i}\n{menu}", None, "b") for i in range(20)]
    rows += [(200, "\n".join([menu] * 20), None, "a"), (201, "\n".join([menu] * 5 + [PROSE]), None, "a")]
    rows += [(300 + i, PROSE + "\ncopied line of a copied text", None, "a") for i in range(40)]  # copies: one document
    out = {r.doc_id: r for r in quality.verdicts(documents(rows)).collect()}
    assert all(out[i].removed_words == 4 and out[i].kept for i in range(25))
    assert all(out[100 + i].removed_words == 0 and out[100 + i].kept for i in range(20))
    assert out[201].removed_words == 20 and out[201].kept
    long = [(400 + i, PROSE + "\n" + PROSE.replace("word", f"own{chr(97 + i)}"), None, "c") for i in range(25)]  # a passage, not furniture
    assert all(r.removed_words == 0 and r.kept for r in quality.verdicts(documents(long)).collect())
    assert all(out[300 + i].removed_words == 0 and out[300 + i].kept for i in range(40))
    thin = quality.verdicts(documents([*rows, (202, f"{menu}\n" * 13 + "alone", None, "a")])).where("doc_id = 202").first()
    assert thin.n_words == 53 and thin.removed_words == 52 and not thin.kept


def test_long_frequent_lines(documents):
    """A notice of over 25 words on pages of their own goes; pages of notices alone are rejected; near copies stay."""

    def own(i, n=60):
        return " ".join(f"w{chr(97 + i)}{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(n))

    def notice(c):
        return " ".join(f"{c}{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(30))

    rows = [(i, f"{own(i)}\n{notice('x')}\n{own(i, 20)[::-1]}\n{notice('y')[:90]}", None, "a") for i in range(22)]
    rows += [(50, f"{notice('x')}\n{notice('x').upper()}", None, "a")]
    copy = [" ".join(f"c{chr(97 + j)}{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(30)) for j in range(20)]
    for i in range(40):  # each changes one of its twenty lines
        lines = list(copy)
        lines[i % 20] = own(0, 30) + f" {chr(97 + i // 20)}"
        rows += [(100 + i, "\n".join(lines), None, "a")]
    out = {r.doc_id: r for r in quality.verdicts(documents(rows)).collect()}
    assert all(out[i].removed_words >= 30 and out[i].kept for i in range(22))
    assert out[50].removed_words == 60 and not out[50].kept
    assert all(out[100 + i].removed_words == 0 and out[100 + i].kept for i in range(40))
    cleaned = {r.doc_id: r.text for r in quality.apply_rules(documents(rows), clean=True).collect()}
    assert 50 not in cleaned and all(notice("x") not in cleaned[i] and own(i) in cleaned[i] for i in range(22))


def test_apply(documents):
    menu = "Home News 12 About"
    rows = [(i, f"{PROSE} {i}\n{menu}\n\nend{chr(97 + i)}", None, "a") for i in range(25)] + [(None, "short", None, None), (7, None)]
    df = documents(rows)
    kept = quality.apply_rules(df)
    assert kept.columns == df.columns
    assert sorted(r.text for r in kept.collect()) == sorted(r[1] for r in rows[:25])
    clean = quality.apply_rules(df, clean=True)
    assert sorted(r.text for r in clean.collect()) == sorted(f"{PROSE} {i}\n\nend{chr(97 + i)}" for i in range(25))
