"""Chats, licences, mixtures and quality rules on hand-made rows; all of them stay in the JVM."""

import hashlib
import re
import textwrap
from collections import Counter, defaultdict

import pytest

from enrolmeter.llm import registry
from enrolmeter.llm.chat_format import CLOSE, OPEN, rotate
from enrolmeter.llm.license_scan import PASSAGES, TEMPLATES, passages, scan, summary
from enrolmeter.llm.mixing import mix
from enrolmeter.llm.quality_rules import judge, statistics

from ..conftest import SMALL

NATIVE = [n for n in registry.QUERIES if n.split("_")[0] in ("op1", "op2", "op4", "op7", "op9")]


@pytest.mark.parametrize("name", NATIVE)
def test_no_python_in_the_plan(spark, name):
    plan = registry.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


# --- chats ------------------------------------------------------------------------------------


def chat(spark, rows):
    return rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string"))


def test_every_participant_is_the_assistant_once(spark):
    rows = [
        (1, 0, "system", "Be kind.", ""), (1, 1, "ana", "Hello?", ""), (1, 2, "bo", "Hi.", ""),
        (1, 2, "bo", "Hi.", ""), (1, 3, "ana", f"{OPEN}x{CLOSE}", ""),
    ]
    got = {r.speaker: r for r in chat(spark, rows).collect()}
    assert set(got) == {"ana", "bo"}
    bo = got["bo"]
    assert bo.rendered == (
        f"{OPEN}system\nBe kind.{CLOSE}\n{OPEN}user name=ana\nHello?{CLOSE}\n{OPEN}assistant\nHi.{CLOSE}\n"
        f"{OPEN}user name=ana\n<im_start>x<im_end>{CLOSE}\n"
    )
    assert [bo.rendered[m.start : m.end] for m in bo.mask] == [f"Hi.{CLOSE}"]
    ana = got["ana"]
    assert [ana.rendered[m.start : m.end] for m in ana.mask] == [f"Hello?{CLOSE}", f"<im_start>x<im_end>{CLOSE}"]
    assert ana.n_messages == 4


def test_long_and_awkward_dialogues(spark):
    rows = [(7, t, "ab"[t % 2], f"é{t}", "") for t in range(150)] + [
        (8, 0, "system", "alone", ""), (None, 0, None, None, ""), (9, None, "a", "when?", ""), (9, None, "a", "so?", ""),
    ]
    got = chat(spark, rows).collect()
    long = sorted((r for r in got if r.conv_id == 7 and r.speaker == "a"), key=lambda r: r.part)
    assert [r.n_messages for r in long] == [64, 64, 22]
    whole = "".join(r.rendered for r in long)
    assert re.findall("é[0-9]+", whole) == [f"é{t}" for t in range(150)]
    spans = [r.rendered[m.start : m.end] for r in long for m in r.mask]
    assert spans == [f"é{t}{CLOSE}" for t in range(0, 150, 2)]
    assert not [r for r in got if r.conv_id == 8]
    assert [(r.speaker, r.rendered) for r in got if r.conv_id is None] == [("unknown", f"{OPEN}assistant\n{CLOSE}\n")]
    assert sum(r.n_messages for r in got if r.conv_id == 9 and r.untimed) == 2


def test_crowded_parts_are_dealt_into_pieces(spark):
    rows = [(5, 4 + t, "ab"[t % 2], f"t{t}", "") for t in range(4)]
    rows += [(5, 5, f"s{k % 3}", f"m{k}", "") for k in range(300)] + [(5, None, "a", f"u{k}", "") for k in range(40)]
    rows += [(5, t, "a", f"early {t}", "") for t in range(3)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string")
    got = [r for r in rotate(table, part_turns=4, part_messages=16).collect() if r.speaker == "s1"]

    def place(row):
        _, turn, role, text, _ = row
        return turn, int(hashlib.md5(f"{role}\n{text}".encode()).hexdigest()[:8], 16), role, text

    timed = sorted((r for r in got if not r.untimed), key=lambda r: (r.part, r.piece))
    said = re.findall(r"\n(.*?)" + re.escape(CLOSE), "".join(r.rendered for r in timed))
    assert said == [text for _, _, _, text in sorted(place(r) for r in rows if r[1] is not None)]
    assert [r.n_messages for r in timed if r.part == 0] == [3]
    assert len([r for r in timed if r.part == 1]) > 15 and max(r.n_messages for r in got) < 40
    own = [r.rendered[m.start : m.end] for r in timed for m in r.mask]
    assert sorted(own) == sorted(f"m{k}{CLOSE}" for k in range(300) if k % 3 == 1)
    assert sum(r.n_messages for r in got if r.untimed) == 40 and len([r for r in got if r.untimed]) > 1


# --- licences ---------------------------------------------------------------------------------


def brute_hits(text):
    def bigrams(unit):
        words = re.findall(r"[^\W_]+", unit.lower())
        return set(zip(words, words[1:]))

    lines = (text or "").split("\n")
    units = list(enumerate(lines)) + ([(-1, text)] if len(lines) > 1 else [])
    out = []
    for number, unit in units:
        best = []
        for name, template in TEMPLATES.items():
            a, b = bigrams(unit), bigrams(template)
            dice = 2 * len(a & b) / (len(a) + len(b))
            if dice >= 0.8:
                best.append((-dice, name))
        if best:
            out.append((number, min(best)[1], round(-min(best)[0], 9)))
    return out


def test_licences_against_brute_force(documents, awkward):
    mit = TEMPLATES["MIT/text"]
    rows = awkward + [
        (30, f"Text before.\n{TEMPLATES['CC-BY-NC-4.0/notice']}\nafter"), (31, mit.replace(". ", ".\n")),
        (32, mit.upper()), (33, mit[: len(mit) // 2]), (34, "Released under the BSD License."),
        (35, f"{TEMPLATES['MIT/notice']}\n{TEMPLATES['GPL-3.0/notice']} and more"), (36, f"{mit} {'pad ' * 300}"),
    ]
    got = scan(documents(rows)).collect()
    found = {(r.doc_id, r.text): [(h.unit, h.name, round(h.dice, 9)) for h in r.hits] for r in got}
    assert len(got) == len(rows)
    assert found == {(r[0], r[1]): brute_hits(r[1]) for r in rows}
    assert found[31, rows[-6][1]][-1][:2] == (-1, "MIT/text")


def brute_best(text, name):
    """The greatest Dice of a run of words with a template, over all runs."""
    words, known = re.findall(r"[^\W_]+", text.lower()), re.findall(r"[^\W_]+", PASSAGES[name].lower())
    b, best = set(zip(known, known[1:])), 0
    for i in range(len(words)):
        a = set()
        for pair in list(zip(words[i:], words[i + 1 :]))[: int((len(known) - 1) * 1.5 + 1e-6)]:
            a.add(pair)
            best = max(best, 2 * len(a & b) / (len(a) + len(b)))
    return best


def test_passages_over_lines_and_inside_them(documents):
    def wrapped(name):
        return "\n".join("# " + line for line in textwrap.wrap(PASSAGES[name], 60))

    pad = "\n".join(f"x{i} = f(y{i}, of the {i})" for i in range(90))
    blocks = ["MIT/text", "GPL-3.0/header", "LGPL-3.0/header", "Apache-2.0/header", "BSD-2-Clause/text", "BSD-3-Clause/text"]
    blocks += ["GPL-2.0/header", "LGPL-2.1/header", "LGPL-3.0/text", "CC0-1.0/text"]
    rows = [(i, f"{pad}\n{wrapped(name)}\n{pad}") for i, name in enumerate(blocks)]
    rows.append((20, f"As said before, {TEMPLATES['CC-BY-4.0/work']} Nothing more {'is said here ' * 9}"))
    rows.append((11, f"{pad}\n{wrapped('MIT/text')}\n{pad}\n{wrapped('MIT/text')}"))
    broken = wrapped("MIT/text").replace("without", "with no").replace("copies", "prints").replace("merge", "and merge")
    rows.append((12, f"{pad}\n{broken}\n{pad}"))
    rows.append((13, f"{pad}\n{TEMPLATES['MIT/notice']}\n{pad}"))  # a line's hit: told once
    rows.append((14, f"{pad} {TEMPLATES['MIT/text'][:500]} {pad}"))
    docs = passages(scan(documents(rows)))
    got = {r.doc_id: r for r in docs.collect()}
    for i, name in enumerate(blocks):
        (one,) = got[i].passages
        assert one.name == name and one.dice == 1.0
    assert [(p.name, p.dice) for p in got[20].passages] == [("CC-BY-4.0/work", 1.0)]
    assert [p.name for p in got[11].passages] == ["MIT/text"] * 2
    (one,) = got[12].passages
    assert one.name == "MIT/text" and 0.8 <= one.dice < 1
    assert abs(one.dice - brute_best(dict(rows)[12], "MIT/text")) < 1e-9
    assert got[13].passages == [] and len(got[13].hits) == 1 and got[14].passages == []
    told = {r.doc_id: r for r in summary(docs).collect()}
    assert told[0].licences == "MIT" and told[11].n_hits == 2 and told[13].n_hits == 1 and told[14].licences == ""


# --- mixtures ---------------------------------------------------------------------------------


def test_shares_reach_their_targets_and_copies_are_numbered(documents):
    rows = [(i, "x" * (i % 9), "big" if i % 3 else "small") for i in range(3000)]
    got = mix(documents(rows, clashing=False), {"big": 0.5, "small": 0.5}).collect()
    size = Counter()
    for r in got:
        size[r.source] += len(r.text) + 1
    assert abs(size["big"] / sum(size.values()) - 0.5) < 0.03
    assert abs(sum(size.values()) / sum(len(r[1]) + 1 for r in rows) - 1) < 0.05
    copies = defaultdict(list)
    for r in got:
        copies[r.doc_id].append(r.copy)
    assert all(sorted(c) == list(range(len(c))) for c in copies.values())
    again = mix(documents(rows, clashing=False).repartition(7), {"big": 0.5, "small": 0.5}).collect()
    assert Counter(got) == Counter(again)


def test_counts_are_poisson_even_for_large_means(documents):
    rows = [(i, "", "rare") for i in range(400)] + [(i, "y" * 999, "rest") for i in range(400, 800)]
    got = mix(documents(rows, clashing=False), {"rare": 0.3}, rest=0.7).where("source = 'rare'")
    counts = Counter(r.doc_id for r in got.select("doc_id").collect())
    values = [counts[i] for i in range(400)]
    mean = sum(values) / 400
    variance = sum((v - mean) ** 2 for v in values) / 400
    assert abs(mean / 300.3 - 1) < 0.02 and 0.75 < variance / mean < 1.3


def test_awkward_mixture(documents, awkward):
    got = mix(documents(awkward), {"s": 1.0}, rest=1.0, epochs=30.0).collect()
    assert {r.doc_id for r in got} <= {r[0] for r in awkward}
    assert None in {r.doc_id for r in got} and {r["pos"] for r in got} == {"x0"}
    assert mix(documents(awkward), {}, rest=0.0).count() == 0


# --- quality rules ----------------------------------------------------------------------------


def brute_stats(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    n = len(words)
    failed = n < 10 or 100 * len(covered) > 20 * n
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_statistics_against_brute_force(documents, awkward):
    rows = awkward + [
        (40, "a b c d e a b c d e f"), (41, "a a a a a"), (42, "a a a a a a"), (43, " #x <y>|&\n#x <y>|&\n \n"),
        (44, "w1 w2 w3 w4 w5 w6 z w1 w2 w3 w4 w5 w6 " + " ".join(f"u{i}" for i in range(99))),
        (45, "\x85   a\x0bb\fc\rd"),
    ]
    got = statistics(documents(rows)).collect()
    actual = Counter(
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got
    )
    assert actual == Counter((r[0], *brute_stats(r[1])) for r in rows)


def test_boilerplate_of_a_host_depletes_its_documents(documents):
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(12))
    menu = "Home About Contact Terms Privacy Help " * 8
    rows = [(i, f"{menu}\n{own(i)}", "host") for i in range(6)]
    rows += [(10, f"{menu}\nonly three words", "host"), (11, f"{menu}\nonly three words", "other")]
    rows += [(20 + i, f"copied whole {own(99)}\n{own(98)}", "host") for i in range(9)]
    got = {r.doc_id: r for r in judge(documents(rows), line_limit=5, min_left_percent=20, copies_count=False).collect()}
    assert got[0].base_failed and not got[0].kept  # the menu repeats its own windows
    assert got[0].n_boilerplate_words == 48 and got[0].clean_text == own(0)
    assert got[10].clean_text == "only three words" and got[11].n_boilerplate_words == 0
    assert got[20].kept and got[20].n_boilerplate_words == 0
    # Every copy counts as a document unless told otherwise.
    got = {r.doc_id: r for r in judge(documents(rows), line_limit=5).collect()}
    assert not got[20].base_failed and not got[20].kept and got[20].clean_text == ""
    assert got[10].n_boilerplate_words == 48 and got[11].n_boilerplate_words == 0


def test_a_line_needs_its_share_of_the_host(documents):
    line = " ".join(f"menu{k}" for k in range(40))
    rows = [(i, f"{line}\nand {i}", "h") for i in range(6)] + [(100 + i, f"page {i}", "h") for i in range(94)]
    rows += [(None, f"no id {i}", "h") for i in range(20)] + [rows[0], (7, f"{line}\nelse", "g")]
    for percent, gone in ((4, True), (5, False)):  # 6 of 120 documents: 5 %
        got = judge(documents(rows), line_limit=5, host_percent=percent).collect()
        assert {r.doc_id for r in got if r.n_boilerplate_words} == (set(range(6)) if gone else set())
        assert len(got) == len(rows)


def test_rows_without_id_hold_lines_by_their_texts(documents):
    rows = [(None, f"the same line\n{i}", "h") for i in range(4)] + [(None, "the same line\n0", "h")]
    got = judge(documents(rows), line_limit=3).collect()
    assert [r.n_boilerplate_words for r in got] == [3] * 5
    assert not [r for r in judge(documents(rows), line_limit=4).collect() if r.n_boilerplate_words]


def test_rules_leave_clashing_columns_as_they_are(spark):
    names = ("gone", "gone_words", "of_words", "own_hash", "b_id", "b_hash", "b_host", "host", "f1", "holder", "total")
    row = (1, "one line of text", "s", *(f"x {n}" for n in names))
    docs = spark.createDataFrame([row], "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names))
    for found in (judge(docs).first(), statistics(docs).first()):
        assert [found[n] for n in names] == [f"x {n}" for n in names]
        assert found.n_words == 4 and found.text == "one line of text" and found.source == "s"


def test_depletion_alone_rejects(documents):
    menu = " ".join(f"menu{k}" for k in range(40))
    rows = [(i, f"{menu}\nand {i}", None) for i in range(6)] + [(9, f"{menu}\n" + " ".join(f"v{k}" for k in range(40)), None)]
    got = {r.doc_id: r for r in judge(documents(rows), line_limit=5).collect()}
    assert not got[0].base_failed and not got[0].kept and got[9].kept
