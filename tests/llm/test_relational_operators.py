"""Operators that compare documents or turns with each other, held against brute force."""

import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import documents, no_documents, odd_rows, prose, sorted_rows
from wardline.llm import chat, components, decontamination, line_dedup, ngram_jaccard, phrase_index, substring_dedup

BLANK = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LAST = 1 << 62


def linked(keys, links):
    """Smallest key of each key's component."""
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {k: find(k) for k in keys}


def test_components_of_random_links(spark):
    pick = random.Random(2)
    links = [(pick.randrange(300), pick.randrange(300)) for _ in range(160)] + [(500 + k, 501 + k) for k in range(40)]
    links += [(1000, 1000 + k) for k in range(1, 60)]
    found = components.components(spark.createDataFrame(links, "a long, b long"))
    keys = {k for a, b in links if a != b for k in (a, b)}
    assert sorted_rows(found, "key", "label") == sorted(linked(keys, [x for x in links if x[0] != x[1]]).items(), key=repr)
    none = spark.createDataFrame([], "a long, b long")
    assert components.components(none).count() == 0
    # The same links in two parts.
    labels = components.components(spark.createDataFrame(links[::2], "a long, b long"))
    again = components.joined(labels, spark.createDataFrame(links[1::2], "a long, b long"))
    assert sorted_rows(again, "key", "label") == sorted_rows(found, "key", "label")
    assert sorted_rows(components.joined(labels, none), "key", "label") == sorted_rows(labels, "key", "label")


def test_packed_fingerprints_come_back():
    codes = np.unique(np.random.default_rng(1).integers(0, 1 << 64, 5000, dtype=np.uint64))
    owners = np.random.default_rng(2).integers(-5, 70_000, len(codes))
    parts = list(phrase_index.dealt(codes, owners, 16))
    assert (np.concatenate([phrase_index.unpack_codes(p[1]) for p in parts]) == codes).all()
    assert (np.concatenate([phrase_index.unpack_owners(p[2], p[3]) for p in parts]) == owners).all()


# Substrings


def removed_words(rows, size):
    """For each row, its words and whether each lies in a window that starts in a row with a smaller id."""
    key = lambda i: LAST if i is None else i
    words = [re.findall(BLANK, t or "") for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words):
        for k in range(len(w) - size + 1):
            gram = tuple(w[k : k + size])
            first[gram] = min(first.get(gram, LAST), key(i))
    out = []
    for (i, _), w in zip(rows, words):
        gone = set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < key(i):
                gone |= set(range(k, k + size))
        out.append((i, w, gone))
    return out


def expected_substrings(rows, size):
    return sorted(
        ((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)) for i, w, gone in removed_words(rows, size)),
        key=repr,
    )


@pytest.mark.parametrize("size", [3, 13])
@pytest.mark.parametrize("block", [200, 1 << 24])
def test_substrings(spark, monkeypatch, size, block):
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", block)
    rows = odd_rows() + [(100 + k, prose(k, 90) + " " + prose(k // 2, 60) + " " + prose(3, 30)) for k in range(40)]
    found = substring_dedup.remove_repeats(documents(spark, rows), size)
    assert sorted_rows(found, "doc_id", "n_words", "n_removed", "kept") == expected_substrings(rows, size)
    for r in found.collect():
        assert sum(f["length"] for f in r["factors"]) == r["n_removed"]
    assert substring_dedup.remove_repeats(no_documents(spark)).count() == 0


def test_substrings_of_the_test_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = substring_dedup.remove_repeats(docs)
    assert sorted_rows(found, "doc_id", "n_words", "n_removed", "kept") == expected_substrings(rows, 13)


# N-gram Jaccard


def expected_jaccard(rows, size, num, den):
    sets = []
    for _, t in rows:
        w = re.findall(BLANK, (t or "").translate(LOWER))
        grams = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
        sets.append(grams)
    links = []
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                links.append((b, a))
    groups = linked(range(len(rows)), links)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[groups[k]] = min(least.get(groups[k], LAST), i)
    # Rows of one id are told apart only by their set.
    return sorted(((i, len(sets[k]), least.get(groups[k])) for k, (i, _) in enumerate(rows)), key=repr)


def near_rows(seed=5):
    """Chains, stars and cliques of near copies."""
    pick, rows = random.Random(seed), []
    for group in range(12):
        base = prose(1000 + group, pick.choice([8, 30, 120, 300])).split(" ")
        now = list(base)
        for _ in range(pick.choice([1, 3, 12])):
            source = now if group % 2 else base
            now = list(source)
            for _ in range(pick.choice([0, 1, 1, 2, 4])):
                now[pick.randrange(len(now))] = pick.choice(["changed", "Word", "other"])
            rows.append((len(rows) + 50, " ".join(now)))
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("size,num,den", [(3, 90, 100), (5, 8, 10), (2, 1, 2), (3, 1, 3)])
def test_near_duplicates(spark, size, num, den):
    rows = odd_rows() + near_rows()
    found = ngram_jaccard.near_duplicates(documents(spark, rows), size, num, den)
    assert sorted_rows(found, "doc_id", "n_shingles", "component_id") == expected_jaccard(rows, size, num, den)


def test_near_duplicates_with_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "BLOCK_BYTES", 300)
    rows = near_rows(6)
    found = ngram_jaccard.near_duplicates(documents(spark, rows), 3, 90, 100)
    assert sorted_rows(found, "doc_id", "n_shingles", "component_id") == expected_jaccard(rows, 3, 90, 100)
    assert ngram_jaccard.near_duplicates(no_documents(spark)).count() == 0


def test_a_large_group_of_near_copies_is_not_paired(spark):
    base = prose(77, 200).split(" ")
    rows = []
    for k in range(150):
        now = list(base)
        now[k] = f"w{k}"
        rows.append((k, " ".join(now)))
    found = ngram_jaccard.near_duplicates(documents(spark, [*rows, (999, " ".join(base))]), 3, 90, 100)
    assert {r["component_id"] for r in found.collect()} == {0}


# Lines


def expected_lines(rows, least, bits, percent):
    """Kept text of each row by comparing every two normalised lines."""
    key = lambda i: LAST if i is None else i
    where = {}
    for row, (i, t) in enumerate(rows):
        for k, line in enumerate((t or "").split("\n")):
            w = re.findall(ALNUM, line.translate(LOWER))
            if len(w) >= least:
                where.setdefault(" ".join(w), []).append((key(i), t, k, row))
    names = sorted(where)
    found = line_dedup.lines_of(pa.array(names, pa.string()))
    marks = line_dedup.simhashes(found, np.arange(len(names)))
    links = []
    for a in range(len(names)):
        for b in range(a):
            if int(marks[a] ^ marks[b]).bit_count() <= bits and close(names[a], names[b], percent):
                links.append((b, a))
    groups = linked(range(len(names)), links)
    first = {}
    for n, name in enumerate(names):
        for place in where[name]:
            first.setdefault(groups[n], []).append(place)
    gone = [set() for _ in rows]
    for places in first.values():
        keeper = min(p[0] for p in places), None
        texts = sorted({p[1] for p in places if p[0] == keeper[0]})
        for doc, text, k, row in places:
            same = doc == keeper[0] and text == texts[0] and k == min(p[2] for p in places if p[0] == doc and p[1] == text)
            if not same:
                gone[row].add(k)
    out = []
    for row, (i, t) in enumerate(rows):
        lines = t.split("\n") if t else []
        out.append((i, len(lines), len(gone[row]), "\n".join(x for k, x in enumerate(lines) if k not in gone[row])))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [3, None])
def test_rows_of_numbers_are_no_copies(spark, bits):
    """Lines that agree but for their digits are compared with their digits."""
    table = ["1987 9876 5432 1098 7654 price", "2021 1200 3400 5600 7800 price", "12 34 56 78 90", "98 76 54 32 10"]
    near = ["the meeting of the board is on page 41 of the report", "the meeting of the board is on page 42 of the report"]
    found = line_dedup.remove_lines(documents(spark, [(1, "\n".join(table)), (2, "\n".join(near)), (3, table[0])]), bits=bits)
    assert sorted_rows(found, "doc_id", "removed") == [(1, []), (2, [1]), (3, [0])]


def close(a, b, percent):
    before = list(range(len(b) + 1))
    for x, c in enumerate(a, 1):
        now = [x]
        for y, d in enumerate(b, 1):
            now.append(min(before[y] + 1, now[-1] + 1, before[y - 1] + (c != d)))
        before = now
    assert before[-1] == line_dedup.edit_distance(a, b)
    return 100 * (max(len(a), len(b)) - before[-1]) >= percent * max(len(a), len(b))


def line_rows(seed=3):
    pick, rows = random.Random(seed), []
    shared = [prose(500 + k, 30, 1) for k in range(6)]
    for k in range(60):
        lines = [prose(pick.randrange(10**9), pick.choice([3, 12, 40]), 1) for _ in range(3)]
        line = pick.choice(shared).split(" ")
        if pick.random() < 0.6:
            line[pick.randrange(len(line))] = pick.choice(["changed", "x1", "x2", "77"])
        lines.insert(pick.randrange(4), " ".join(line))
        rows.append((k + 200, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("bits", [0, 3, 6])
def test_lines(spark, bits):
    # Two texts under one id that share their first line would be ordered by a hash; leave those out.
    rows = [r for r in odd_rows() if r[0] not in (11, 12)] + line_rows()
    found = line_dedup.remove_lines(documents(spark, rows), bits=bits, carry=["doc_id", "row"])
    assert sorted_rows(found, "doc_id", "n_lines", "n_removed", "kept") == expected_lines(rows, 5, bits, 80)
    assert line_dedup.remove_lines(no_documents(spark)).count() == 0


def test_tables_without_repeated_lines(spark):
    rows = [(k, prose(k)) for k in range(3)] + [(9, None), (10, "")]
    found = line_dedup.remove_lines(documents(spark, rows))
    assert sorted_rows(found, "doc_id", "n_removed", "kept") == sorted(((i, 0, t or "") for i, t in rows), key=repr)


def test_layouts_find_the_same_lines(spark, monkeypatch):
    rows = line_rows(8)
    found = []
    for nodes in (1, 1 << 22, 1 << 40):
        layout = line_dedup.layout_for(nodes, 3)
        assert all(sum(int(m) >> b & 1 for m in layout.masks()) for b in range(64))
        monkeypatch.setattr(line_dedup, "layout_for", lambda *_, layout=layout: layout)
        found.append(sorted_rows(line_dedup.remove_lines(documents(spark, rows)), "doc_id", "removed"))
    assert found[0] == found[1] == found[2]


def test_large_groups_of_a_key_are_whole(spark, monkeypatch):
    rows = line_rows(9)
    expected = expected_lines(rows, 5, 3, 80)
    monkeypatch.setattr(line_dedup, "SMALL_GROUP", 1)
    found = line_dedup.remove_lines(documents(spark, rows))
    assert sorted_rows(found, "doc_id", "n_lines", "n_removed", "kept") == expected


def edited_lines(seed=4):
    """Documents with one line each: pairs of a line and a copy with one edit, by their length in words."""
    pick, rows = random.Random(seed), []
    for k in range(160):
        words = prose(9000 + k, pick.choice([6, 12, 25, 45]), 1).split(" ")
        other = list(words)
        at = pick.randrange(len(words))
        if k % 4 == 0:
            other[at] = "changed"
        elif k % 4 == 1:
            other[at] = other[at][:-1] + "q"
        elif k % 4 == 2:
            other.insert(at, "more")
        else:
            del other[at]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    return rows


def test_lines_linked_by_edit_similarity_alone(spark):
    rows = edited_lines()
    normal = [" ".join(re.findall(ALNUM, t.translate(LOWER))) for _, t in rows]
    links = [(a, b) for b in range(len(rows)) for a in range(b) if line_dedup.similar(normal[a], normal[b], 80)]
    groups = linked(range(len(rows)), links)
    wanted = {rows[k][0] for k in range(len(rows)) if k != min(n for n in range(len(rows)) if groups[n] == groups[k])}
    found = line_dedup.remove_lines(documents(spark, rows), bits=None)
    removed = {r["doc_id"] for r in found.where("n_removed > 0").collect()}
    assert removed <= wanted and len(removed) >= 0.97 * len(wanted) > 100


def test_short_lines_and_lines_without_blanks(spark):
    chinese = "我们在这里发布最新的新闻和文章，欢迎大家阅读并且转发给更多的朋友。"
    rows = [
        (1, "Read more\n" + chinese + "\nPrice list"),
        (2, "read more!\n" + chinese + "\nPrice lists"),
        (3, chinese.replace("朋", "亲") + "\n...\nok"),
        (4, "...\nOK\nalone"),
    ]
    found = line_dedup.remove_lines(documents(spark, rows), bits=None)
    assert sorted_rows(found, "doc_id", "removed") == [(1, []), (2, [0, 1]), (3, [0]), (4, [1])]


# Decontamination


def test_windows_of_items(spark, monkeypatch):
    tests = [(1, prose(1, 40)), (2, prose(2, 6, 1)), (3, "na na na"), (4, None), (5, " . "), (6, prose(1, 40)), (None, "one two")]
    items = spark.createDataFrame([(i, t, 0) for i, t in tests], "item_id long, text string, doc_id int")
    rows = odd_rows() + [(300, "x y " + prose(1, 40)[30:] + " z"), (301, prose(2, 6, 1) + " " + prose(8))]
    grams = []
    for i, t in tests:
        w = re.findall(ALNUM, (t or "").translate(LOWER))
        n = min(10, len(w))
        grams += [(i, tuple(w[k : k + n])) for k in range(len(w) - n + 1)] if n else []
    expected = []
    for i, t in rows:
        w = re.findall(ALNUM, (t or "").translate(LOWER))
        hit, seen = set(), set()
        for item, gram in grams:
            for k in range(len(w) - len(gram) + 1):
                if tuple(w[k : k + len(gram)]) == gram:
                    hit |= set(range(k, k + len(gram)))
                    seen.add(item)
        expected.append((i, len(w), len(hit), sorted(seen, key=repr)))
    expected.sort(key=repr)

    def found():
        result = decontamination.find_phrases(documents(spark, rows), items)
        out = []
        for r in result.collect():
            assert all(a["start"] + a["length"] < b["start"] for a, b in zip(r["hits"], r["hits"][1:]))
            out.append((r["doc_id"], r["n_words"], sum(h["length"] for h in r["hits"]), sorted(set(r["items"]), key=repr)))
        return sorted(out, key=repr)

    assert found() == expected
    monkeypatch.setattr(decontamination, "SEGMENT_BYTES", 300)
    assert found() == expected
    monkeypatch.setattr(decontamination, "QUERY_WORDS", 3)  # one item at a time
    assert found() == expected


def test_proximity(spark):
    items = spark.createDataFrame([(1, "red fox jumps"), (2, "blue blue bird")], "item_id long, text string")
    rows = [(1, "a fox then red that jumps high"), (2, "red one two three four five fox jumps"), (3, "Bird. Blue!"), (4, None)]
    near = decontamination.find_near(documents(spark, rows), items, span=5)
    assert sorted_rows(near, "doc_id", "item_id", "start") == [(1, 1, 1), (3, 2, 0)]


def test_empty_sides_of_decontamination(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    found = decontamination.find_phrases(documents(spark), none)
    assert found.count() == len(odd_rows()) and found.where("size(hits) > 0 or size(items) > 0").count() == 0
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontamination.find_phrases(no_documents(spark), some).count() == 0
    assert decontamination.find_near(no_documents(spark), some).count() == 0
    assert decontamination.find_near(documents(spark), none).count() == 0


# Chat


def node_frame(spark, rows):
    return spark.createDataFrame(rows, "tree_id long, node_id long, parent_id long, role string, text string, score double")


def test_paths_are_ranked_by_their_score(spark):
    rows = [
        (1, 1, None, "user", "q", 0.0),
        (1, 2, 1, "assistant", "good", 3.0),
        (1, 3, 1, "assistant", "bad", -1.0),
        (1, 4, 2, "user", "more", 0.0),
        (1, 5, 4, "assistant", "best", 3.0),
        (2, 1, 99, "user", "its parent is missing", None),
        (3, 1, 2, "user", "a cycle", 0.0),
        (3, 2, 1, "user", "a cycle", 0.0),
        (3, 3, 2, "user", "hangs from it", 0.0),
        (None, 1, None, "user", "no tree id", 0.0),
    ]
    nodes = node_frame(spark, rows)
    texts = lambda r: [t["text"] for t in r["turns"]]
    for best, expected in ((1, {(1, 1): ["q", "good", "more", "best"]}), (None, {(1, 1): ["q", "good", "more", "best"], (1, 2): ["q", "bad"]})):
        formatted = chat.format_trees(nodes, best).withColumn("turns", chat.read_turns(F.col("formatted")))
        found = {(r["tree_id"], r["rank"]): texts(r) for r in formatted.collect()}
        assert found == {**expected, (2, 1): ["its parent is missing"], (None, 1): ["no tree id"]}


def test_long_chains(spark):
    rows = [(1, k, k - 1 if k else None, "user", str(k), 1.0) for k in range(77)]
    (row,) = chat.format_trees(node_frame(spark, rows)).withColumn("turns", chat.read_turns(F.col("formatted"))).collect()
    assert [t["text"] for t in row["turns"]] == [str(k) for k in range(77)] and row["path_score"] == 1.0


def test_control_strings_are_escaped_reversibly(spark):
    tricky = ["", None, "\\", "\\\\l", "\\b\\l\\s\\n", "end \\", "</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\nx", "<<SYS>><s>", "<|im_<|im_end|>", "a\nb\n"]
    tricky += ["".join(random.Random(k).choice(["<", "|", "im_start", "im_end", ">", "\\", "n", "l", "\n", "[", "INST", "]", "/", "s"]) for _ in range(20)) for k in range(60)]
    turns = [(k // 4, k % 4, "assistant" if k % 2 else t, t) for k, t in enumerate(tricky)]
    turns += [(None, None, None, None), (None, None, None, None), (7, 1, "user", "tie b"), (7, 1, "user", "tie a")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    formatted = chat.format_trees(chat.conversation_nodes(frame)).select(
        "tree_id",
        "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("learned"),
    )
    rows = {r["tree_id"]: r for r in formatted.collect()}
    order = lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or "")
    for conv in {t[0] for t in turns}:
        own = [(r or "", t or "") for _, _, r, t in sorted((t for t in turns if t[0] == conv), key=order)]
        assert sorted((t["role"], t["text"]) for t in rows[conv]["turns"]) == sorted(own)
        assert rows[conv]["formatted"].count("<|im_start|>") == len(own) == rows[conv]["formatted"].count("<|im_end|>")
        assert len(rows[conv]["learned"]) == sum(len(t) for r, t in own if r == "assistant")
    assert chat.format_trees(chat.conversation_nodes(frame.limit(0))).count() == 0


def test_shuffles_of_written_steps_are_freed(spark):
    def shuffled():
        return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").count("shuffle_")

    counts = spark.range(20_000).groupBy((F.col("id") % 5000).alias("k")).agg(F.count("*").alias("n"))
    line_dedup.free_shuffles(spark)
    time.sleep(2)
    before = shuffled()
    line_dedup.written(counts, "counts")
    one = shuffled() - before
    steps = [line_dedup.written(counts, "counts") for _ in range(7)]
    # The plan of the last step can still be in use.
    until = time.time() + 20
    while shuffled() > before + 2 * one and time.time() < until:
        time.sleep(0.2)
    assert one > 0 and shuffled() <= before + 2 * one
    assert all(step.count() == 5000 for step in steps)
