"""Line numbers of splittable files, nested folders, form order."""
import os

from portalforge.sources import files


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


def _small_blocks(spark, size):
    class Blocks:
        def __enter__(self):
            self.old = [spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")]
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            spark.conf.set("spark.sql.files.openCostInBytes", "16")

        def __exit__(self, *_):
            spark.conf.set("spark.sql.files.maxPartitionBytes", self.old[0])
            spark.conf.set("spark.sql.files.openCostInBytes", self.old[1])
    return Blocks()


def test_numbers_of_files_larger_than_a_block(spark, tmpdir_fresh):
    lines = {f"{tmpdir_fresh}/{d}/f{i}.txt": [f"{d} {i} line {n}" + "y" * (n % 17) for n in range(700 + i)]
             for d in ("a", "b/c") for i in range(3)}
    for path, rows in lines.items():
        _write(path, "\n".join(rows) + ("\n" if "a/" in path else ""))
    with _small_blocks(spark, 2048):
        df = files.numbered_lines(spark, tmpdir_fresh, suffix=".txt", recursive=True)
        assert files.located(spark.read.text(tmpdir_fresh + "/a")).select("block").distinct().count() > 5
        got = {}
        for r in df.collect():
            got.setdefault("/" + r.source_path.removeprefix("file:").lstrip("/"), {})[r.line_no] = r.line
    assert {p: [rows[n] for n in sorted(rows)] for p, rows in got.items()} == lines
    assert all(sorted(rows) == list(range(1, len(rows) + 1)) for rows in got.values())


def test_a_filter_on_the_file_does_not_move_numbers(spark, tmpdir_fresh):
    for i in range(5):
        _write(f"{tmpdir_fresh}/f{i}.txt", "".join(f"{i}:{n}\n" for n in range(50)))
    df = files.numbered_lines(spark, tmpdir_fresh).filter("source_path like '%f3.txt'")
    assert sorted((r.line_no, r.line) for r in df.collect()) == [(n + 1, f"3:{n}") for n in range(50)]


def test_carriage_returns_blank_and_empty_files(spark, tmpdir_fresh):
    _write(f"{tmpdir_fresh}/x.txt", "a\r\n\r\nb\rc\n")
    _write(f"{tmpdir_fresh}/empty.txt", "")
    got = sorted((r.line_no, r.line) for r in files.numbered_lines(spark, tmpdir_fresh).collect())
    assert got == [(1, "a"), (2, ""), (3, "b\rc")]


def test_forms_are_numbered_by_name(spark, tmpdir_fresh):
    for name in ("form_10", "form_2", "form_1"):
        _write(f"{tmpdir_fresh}/q/{name}.txt", f"{name}\nx\n")
    _write(f"{tmpdir_fresh}/q/note.md", "no form")
    got = sorted({(r.form_no, r.form_id) for r in files.read_forms(spark, tmpdir_fresh, suffix=".txt", recursive=True).collect()})
    assert got == [(1, "form_1.txt"), (2, "form_10.txt"), (3, "form_2.txt")]
