"""Sources, sinks, whole runs and the stream, on records of our own making."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from knotwork.operators import model, validate
from knotwork.operators.blocking import BlockerConfig
from knotwork.plans import cli, pipeline
from knotwork.sources import io
from knotwork.streaming.normalize import normalize_stream

HEADER = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"


def make_folder(path, prefix, seed, n):
    """``n`` entities, most of them with noisy matches in sources 2 and 3, and unmatched records."""
    rng = random.Random(seed)
    first, second = "blue red green amber silver golden iron maple cedar willow".split(), "stone kite river harbor forge lantern meadow anchor falcon orchard".split()
    rows = {1: [], 2: [], 3: []}
    labels, at = [], seed * 10_000
    for i in range(n):
        name = f"{rng.choice(first).title()} {rng.choice(second).title()} {rng.choice(second).title()}"
        number, street, state, code = rng.randint(1, 999), rng.choice(second).title(), *rng.choice([("North Carolina", "NC"), ("New York", "NY"), ("Texas", "TX")])
        s1 = f"S1-{seed * 10_000 + i}"
        rows[1].append(f"{s1}\t{name} LLC\t{number} {street} Street, Troy, {state}\tUS")
        ids = []
        for source in (2, 3):
            if rng.random() < 0.8:
                at += 1
                ids.append(f"S{source}-{at}")
                rows[source].append(f"{ids[-1]}\t{rng.choice([name.upper(), name + ' Inc', ' '.join(reversed(name.split()))])}\t0{number} {street} St, Troy, {code}\tUS")
            at += 1
            rows[source].append(f"S{source}-{at}\t{rng.choice(first)} {rng.choice(second)} {rng.randint(1, 99)}\t{rng.choice(['', '7 Far Road, Austin, TX'])}\tUS")
        labels.append(f"{s1}\t{','.join(ids)}")
    path.mkdir(parents=True, exist_ok=True)
    for k, lines in rows.items():
        (path / f"{prefix}_source{k}.tsv").write_text(HEADER + "\n".join(lines) + "\n")
    (path / f"{prefix}_ground_truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + "\n".join(labels) + "\n")
    return path


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    top = tmp_path_factory.mktemp("records")
    return make_folder(top / "train", "train", 1, 60), make_folder(top / "test", "test", 2, 15)


def test_read_records(spark, tmp_path):
    text = HEADER + 'S1-1\t" Quoted ""x"" "\t a \tUS\nS1-1\tlast\nS1-2\tb\t\tIndia\n'
    (tmp_path / "t.tsv").write_text(text)
    got = {r["entity_id"]: tuple(r)[1:] for r in io.read_records(spark, str(tmp_path / "t.tsv")).collect()}
    assert got == {"S1-1": ("last", "", ""), "S1-2": ("b", "", "India")}
    assert io.read_records(spark, str(tmp_path / "t.tsv"), limit=1).count() == 1
    (tmp_path / "n.tsv").write_text("country\tname\taddress\tentity_id\nUS\tx\ty\tS2-1\n")
    assert tuple(io.read_records_by_name(spark, str(tmp_path / "n.tsv")).first()) == ("S2-1", "x", "y", "US")
    with pytest.raises(FileNotFoundError):
        io.read_records(spark, str(tmp_path / "none.tsv"))


def test_labels_and_lists(spark, tmp_path):
    (tmp_path / "l.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-2, S2-1,,\nS1-2\t\nS1-1\tS3-1\n")
    got = {r["s1_id"]: r["match_ids"] for r in io.read_labels(spark, str(tmp_path / "l.tsv")).collect()}
    assert got == {"S1-1": ["S2-1", "S2-2", "S3-1"], "S1-2": []}
    pairs, spine = io.read_pairs(spark, str(tmp_path / "l.tsv"))
    io.write_matches(pairs, spine, str(tmp_path / "out"), single=True)
    lines = next((tmp_path / "out").glob("part*")).read_text().splitlines()
    assert lines == ["source1_entity_id\tmatched_entity_ids", "S1-1\tS2-1,S2-2,S3-1", "S1-2\t"]


def test_shards(spark, tmp_path, folders):
    source = folders[0] / "train_source2.tsv"
    m = io.write_shards(spark, str(source), str(tmp_path / "source2"), rows=20).collect()
    n = len(source.read_text().splitlines()) - 1
    assert sum(r["rows"] for r in m) == n and max(r["rows"] for r in m) <= 20 and all(len(r["sha256"]) == 64 for r in m)
    assert io.file_sha256(spark, str(source)) is not None
    shards = io.write_folder_shards(spark, str(folders[1]), str(tmp_path / "all"), gz=False)
    assert set(shards) == {"test_source1", "test_source2", "test_source3", "test_ground_truth"}


def test_gzip_directory_and_finders(spark, tmp_path, folders):
    import gzip

    d = tmp_path / "train_source1"
    d.mkdir()
    for k in (1, 2):
        (d / f"x_part_{k}.tsv.gz").write_bytes(gzip.compress((HEADER + f"S1-{k}\ta\tb\tUS\n").encode()))
    (d / "other.tsv").write_text(HEADER + "S1-9\ta\tb\tUS\n")
    assert {r[0] for r in io.read_records(spark, str(tmp_path / "train_source1.tsv")).collect()} == {"S1-1", "S1-2"}
    assert io.find_table(spark, str(tmp_path), "source1").endswith("train_source1")
    assert io.first_existing(spark, [str(tmp_path / "no"), str(tmp_path)]) == str(tmp_path)
    assert io.newest(spark, str(folders[0]), "source2").endswith("train_source2.tsv")
    assert io.match_targets(spark, str(folders[1])).count() > 30 and io.match_targets(spark, str(tmp_path)) is None


def test_json(spark, tmp_path):
    path = str(tmp_path / "m.json")
    assert io.read_json(spark, path) is None
    io.write_json(spark, path, {"a": [1, "é"]})
    io.write_json(spark, path, {"a": 2})
    assert io.read_json(spark, path) == {"a": 2}
    (tmp_path / "bad.json").write_text("{")
    assert io.read_json(spark, str(tmp_path / "bad.json")) is None


def test_sampled_subset(spark):
    df = spark.range(1000).select(F.concat(F.lit("S2-"), F.col("id").cast("string")).alias("entity_id"))
    needed = df.limit(5)
    got = io.sampled_subset(df, needed, distractors=50)
    assert got.count() == 55 and got.join(needed, "entity_id").count() == 5


SMALL = model.ModelConfig(trees=5, step=0.3, depth=3, min_child=1, blocker=BlockerConfig(use_tfidf=False))


def test_run(spark, tmp_path, folders):
    config = pipeline.RunConfig(str(folders[0]), str(folders[1]), str(tmp_path), run_id="r", mirror_dir=str(tmp_path / "mirror"), distractors=100, model=SMALL)
    matches = pipeline.Run(spark, config).execute()
    card = json.loads((tmp_path / "runs/r/scorecard.json").read_text())
    assert card["n_s1_entities"] == 15 and card["blocking_pair_recall"] > 0.9 and card["official_macro_f05"] > 0.7
    assert card["cartesian_space"] == 15 * (card["cartesian_space"] // 15) and len(card) == 24
    assert (tmp_path / "mirror/latest/scorecard.json").exists()
    again = pipeline.Run(spark, config).execute()  # every stage is read, none made again
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, matches.collect()))
    # the saved model has all settings; a smoke run with it takes few targets beside the true ones
    assert model.PairModel.load(spark, str(tmp_path / "runs/r/model")).config == SMALL
    smoke = pipeline.RunConfig(str(folders[0]), str(folders[1]), str(tmp_path), run_id="s", smoke=True, model_path=str(tmp_path / "runs/r/model"), model=SMALL)
    pipeline.Run(spark, smoke).execute()
    small = json.loads((tmp_path / "runs/s/scorecard.json").read_text())
    assert small["n_s1_entities"] == 15 and small["blocking_pair_recall"] == card["blocking_pair_recall"]
    # the written file passes validation
    io.write_matches(matches, io.read_ids(spark, str(folders[1] / "test_source1.tsv")).withColumnRenamed("entity_id", "s1_id"), str(tmp_path / "one"), single=True)
    file = str(next((tmp_path / "one").glob("part*")))
    assert validate.validate(spark, file, None, str(folders[1]), check_ids=True) == ([], [])
    assert validate.validate(spark, str(folders[0] / "train_source1.tsv"), None, str(folders[1]))[0]
    assert cli.main(["validate", "--matching", file, "--test-dir", str(folders[1])]) == 0
    assert cli.main(["report", "--matching", file, "--test-dir", str(folders[1]), "--output", str(tmp_path / "a.txt"), str(tmp_path / "b.txt")]) == 0
    assert (tmp_path / "b.txt").read_text().endswith("valid\n") and "n_rows: 15" in (tmp_path / "a.txt").read_text()


def test_sample_command(spark, tmp_path, folders):
    out = str(tmp_path / "sets")
    assert cli.main(["sample", "--data-dir", str(folders[0]), "--output-dir", out, "--n-test", "5", "--n-train", "20"]) == 0
    test, train = (pipeline.labels(spark, f"{out}/{p}", (p,))[1] for p in ("test", "train"))
    assert (test.count(), train.count(), test.intersect(train).count()) == (5, 20, 0)


def test_holdout_refuses_leakage(spark, folders):
    with pytest.raises(ValueError):
        pipeline.holdout(spark, str(folders[0]), str(folders[0]), SMALL)


def test_stream(spark, tmp_path, folders):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.tsv").write_text((folders[1] / "test_source1.tsv").read_text())
    q = normalize_stream(spark, str(source), str(tmp_path / "out"), str(tmp_path / "state"))
    q.awaitTermination(120)
    (source / "b.tsv").write_text(HEADER + "S1-x\tBlue Co\t1 Oak St\tUS\n")
    normalize_stream(spark, str(source), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 16 and got.where("entity_id = 'S1-x'").first()["address"] == "1 oak street"


def test_small_files_are_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "note.txt")
    for text in ("first, and longer", "second"):
        io.write_text(spark, path, text)
        assert (tmp_path / "note.txt").read_text() == text
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["note.txt"]
    assert io.file_sha256(spark, path) == hashlib.sha256(b"second").hexdigest()
    assert io.file_sha256(spark, f"{path}.none") is None


def test_cells_lose_white_space_of_all_kinds(spark, tmp_path):
    (tmp_path / "r.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n S1-1 \t Fern Hall\x1f\t \x0b9 Elm\x0c\tUS　\n")
    row = io.read_records(spark, str(tmp_path / "r.tsv")).first()
    assert tuple(row) == ("S1-1", "Fern Hall", "9 Elm", "US")


def test_lines_without_tab_are_counted(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + "S1-1\n" * 7 + "S1-2\tS2-1\n")
    required = spark.createDataFrame([("S1-2",)], "s1_id string")
    errors, _ = validate.validate_file(spark, str(tmp_path / "m.tsv"), "matching", required)
    assert [e for e in errors if "tab" in e][0].endswith("7 lines without a tab, first 2, 3, 4, 5, 6")
