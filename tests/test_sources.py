import gzip
import hashlib
from urllib.parse import unquote

import pytest
from card_rows import card, rows_of

from tallyframe import CARD, file_hashes, manifest, prepare, read_snapshot, require_digest, source_pin
from tallyframe.contract import MALFORMED
from tallyframe.operators.quality import snapshot_digest, unique_rows
from tallyframe.sources.export import write_csv, write_json

HEADER = ",".join(CARD.columns)


def write(path, *lines, header=HEADER):
    path.write_text("\n".join([header, *lines]) + "\n")
    return str(path)


def line(**changes):
    return ",".join("" if v is None else v for v in card(**changes))


def test_all_columns_are_text_in_contract_order(spark, tmp_path):
    order = list(reversed(CARD.columns))
    fields = dict(zip(CARD.columns, card(ID="007", AGE=None)))
    path = write(
        tmp_path / "a.csv", ",".join(fields[c] or "" for c in order), header=",".join(order)
    )
    frame = read_snapshot(spark, path)
    assert frame.dtypes == [(c, "string") for c in (*CARD.columns, MALFORMED)]
    row = frame.first()
    assert (row.ID, row.AGE, row.LIMIT_BAL) == ("007", None, "100000")


@pytest.mark.parametrize("header", [
    HEADER.replace("AGE", "age"),
    HEADER.replace(",AGE", ""),
    HEADER + ",EXTRA",
    HEADER.replace("SEX", "ID"),
])
def test_another_header_is_refused(spark, tmp_path, header):
    with pytest.raises(ValueError, match="Input schema mismatch"):
        read_snapshot(spark, write(tmp_path / "a.csv", line(), header=header))


def test_a_second_file_with_another_column_order_is_refused(spark, tmp_path):
    write(tmp_path / "a.csv", line())
    write(tmp_path / "b.csv", line(), header=",".join(reversed(CARD.columns)))
    with pytest.raises(Exception, match="(?i)header"):
        read_snapshot(spark, str(tmp_path)).collect()


def test_files_in_folders_below_belong_to_the_snapshot(spark, tmp_path):
    write(tmp_path / "a.csv", line())
    (tmp_path / "day=1").mkdir()
    write(tmp_path / "day=1" / "b.csv", line(ID="2"))
    (tmp_path / "_SUCCESS").write_text("")
    frame = read_snapshot(spark, str(tmp_path))
    assert rows_of(frame, "ID") == [("1",), ("2",)]


def test_rows_with_surplus_or_missing_fields_are_rejected(spark, tmp_path):
    path = write(
        tmp_path / "a.csv", line(), line(ID="2") + ",surplus", "3,100000", line(ID="4"),
        line(ID="5", AGE="x") + ",1,2",
    )
    bronze, accepted, rejected = prepare(read_snapshot(spark, path), "a" * 64)
    assert rows_of(accepted, "ID") == [(1,), (4,)]
    assert rows_of(rejected, "ID", "rejection_reason") == [
        ("2", "malformed_row"), ("3", "missing_or_noninteger"), ("5", "missing_or_noninteger"),
    ]
    assert rejected.where("ID = '2'").first().malformed_text == line(ID="2") + ",surplus"
    assert bronze.count() == 5


def test_a_clean_row_has_the_same_hash_from_a_file_and_from_memory(spark, cards, tmp_path):
    path = write(tmp_path / "a.csv", line(), line(ID="2") + ",surplus")
    read = {r.ID: r.record_hash for r in prepare(read_snapshot(spark, path), "a" * 64)[0].collect()}
    made = {r.ID: r.record_hash for r in prepare(cards(card(), card(ID="2")), "a" * 64)[0].collect()}
    assert read["1"] == made["1"] and read["2"] != made["2"]


def sha256(path):
    digest = hashlib.sha256()
    with open(path, "rb") as file:
        while block := file.read(1 << 20):
            digest.update(block)
    return digest.hexdigest()


def hashes(spark, folder):
    return {unquote(r.path.rpartition("/")[2]): (r.length, r.sha256) for r in file_hashes(spark, str(folder)).collect()}


def test_a_pin_is_the_sha256_of_one_file(spark, tmp_path):
    path = tmp_path / "a.csv"
    write(path, line(), line(ID="2"))
    digest = source_pin(spark, str(path))
    assert digest == source_pin(spark, str(tmp_path)) == sha256(path)
    assert require_digest(digest, digest) == digest
    with pytest.raises(ValueError, match="checksum"):
        require_digest(digest, "0" * 64)


def test_bytes_of_any_kind_are_hashed_as_they_are(spark, tmp_path):
    """Line ends of all kinds, byte order marks, bytes that are no text, packed files, odd names."""
    (tmp_path / "sub dir").mkdir()
    bodies = {
        "plain": b"a\nb\n", "open end": b"a\nb", "crlf": b"a\r\nb\r\n\r\n", "cr": b"\ra\rb\r", "blank": b"\n", "blanks": b"\n\n\n", "one": b"x",
        "mark": b"\xef\xbb\xbf", "mark line": b"\xef\xbb\xbf\n", "mark text": b"\xef\xbb\xbfa\n\xef\xbb\xbfb", "two marks": b"\xef\xbb\xbf\xef\xbb\xbf\n",
        "no text": bytes(range(256)) * 3, "zeros": b"\0" * 5000, "a+b%20=\u00e9.csv": b"odd,name\n", "packed.gz": gzip.compress(b"a\nb\n"),
        "long": b"y" * 3_000_000 + b"\n" + b"z" * 5_000_000, "many": b"1,2\n" * 30_000,
    }
    for n, (name, body) in enumerate(bodies.items()):
        (tmp_path / ("sub dir" if n % 2 else ".") / name).write_bytes(body)
    (tmp_path / "empty").write_bytes(b"")
    assert hashes(spark, tmp_path) == {n: (len(b), hashlib.sha256(b).hexdigest()) for n, b in bodies.items()}


def test_a_file_beyond_256_mib_is_pinned_in_one_task(spark, tmp_path):
    path, block = tmp_path / "big.csv", b"7,100000,AUTOMOBILE,0,0,0,0,0,0,1234567,0\r\n" * 25_000
    with open(path, "wb") as file:
        for n in range(280):
            file.write(str(n).encode() + block)
    assert path.stat().st_size > 256 << 20
    found = file_hashes(spark, str(path))
    assert found.first().sha256 == sha256(path) == source_pin(spark, str(path))


def test_a_file_read_in_parts_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"1,2\n" * 50_000)
    found = file_hashes(spark, str(tmp_path))
    found.sparkSession.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    with pytest.raises(Exception, match="not read in one piece"):
        found.collect()


def test_a_folder_is_pinned_by_a_manifest(spark, tmp_path):
    """Place and listing do not matter; a name, a byte, a file more or less does."""
    def folder(name, **files):
        for inner, body in files.items():
            place = tmp_path / name / inner.replace("_", "/")
            place.parent.mkdir(parents=True, exist_ok=True)
            place.write_text(body)
        return str(tmp_path / name)

    pin = source_pin(spark, folder("x", a="1", d_b="2", d_c="3"))
    assert source_pin(spark, folder("y y", d_c="3", d_b="2", a="1")) == pin
    others = [folder("p", a="1", d_b="2"), folder("q", a="1", d_b="2", d_c="4"), folder("r", a="1", d_b="2", e_c="3"), folder("s", a="1", d_b="3", d_c="2"), folder("t", a="1", d_b="2", d_c="3", f="")]
    assert [source_pin(spark, o) == pin for o in others] == [False, False, False, False, True]
    row = manifest(file_hashes(spark, str(tmp_path / "x"))).first()
    assert (row.files, row.bytes, row.digest, row.sha256) == (3, 3, pin, None)
    words = [sum(int(hashlib.sha256(f"{n}\n{hashlib.sha256(b.encode()).hexdigest()}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for n, b in (("a", "1"), ("d/b", "2"), ("d/c", "3"))) for k in range(8)]
    assert pin == hashlib.sha256("|".join(map(str, [3, *words])).encode()).hexdigest()


def test_what_has_no_file_cannot_be_pinned(spark, tmp_path):
    with pytest.raises(ValueError, match="no file to pin"):
        source_pin(spark, str(tmp_path))


def test_the_identity_ignores_files_rows_and_columns_in_another_order(spark, tmp_path):
    rows = [line(ID=str(n)) for n in range(50)]

    def identity(*files, header=HEADER):
        folder = tmp_path / str(len(list(tmp_path.iterdir())))
        folder.mkdir()
        for n, lines in enumerate(files):
            (folder / f"part-{n}.csv").write_text("\n".join([header, *lines]))
        return snapshot_digest(unique_rows(read_snapshot(spark, str(folder)))).first().digest

    turned = [",".join(reversed(r.split(","))) for r in rows]
    same = {
        identity(rows), identity(rows[::-1]), identity(rows[:7], rows[7:]),
        identity(turned, header=",".join(reversed(CARD.columns))),
    }
    assert len(same) == 1
    others = {identity(rows[:-1]), identity([*rows, rows[0]]), identity([*rows[:-1], rows[0]]), identity([*rows[:-1], rows[-1] + ",x"])}
    assert len(others) == 4 and not same & others


def test_reports_can_be_written(spark, tmp_path):
    report = spark.range(3).selectExpr("id", "IF(id = 1, NULL, 'x') AS name").orderBy("id")
    write_csv(report, str(tmp_path / "csv"))
    write_json(report, str(tmp_path / "json"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.count() == 3 and back.columns == ["id", "name"]
    assert "name" in spark.read.text(str(tmp_path / "json")).where("value LIKE '%:1,%'").first()[0]
