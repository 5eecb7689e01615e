import json
import os
import zipfile

from pyspark.sql import functions as F

from wavefold.operators.layout import Layout, Variable
from wavefold.plans.repository import Archive
from wavefold.sources import workbook as WB

GRID = [["Identificação"], ["1", "2", "UF", "", "Unidade", "", "", ""], ["3", "4", "V1008", "", "Domicílio"]]


def build_tree(root):
    data_dir = os.path.join(root, "originals", "trimestral", "2024")
    doc_dir = os.path.join(root, "originals", "trimestral", "Documentacao")
    old_dir = os.path.join(root, "originals", "trimestral", "Projecoes_Anteriores")
    for d in (data_dir, doc_dir, old_dir):
        os.makedirs(d)
    with zipfile.ZipFile(os.path.join(data_dir, "PNADC_012024_20250101.zip"), "w") as z:
        z.writestr("PNADC_012024.txt", "110001\n120042\n")
    with zipfile.ZipFile(os.path.join(old_dir, "PNADC_012024.zip"), "w") as z:
        z.writestr("PNADC_012024.txt", "990009\n")
    with zipfile.ZipFile(os.path.join(doc_dir, "Dicionario_e_input.zip"), "w") as z:
        z.writestr("dicionario_PNADC_microdados.xlsx", WB.xlsx_bytes(GRID))
        z.writestr("input_PNADC.txt", "sas program")
    with open(os.path.join(doc_dir, "dicionario_PNADC_microdados.xlsx"), "wb") as out:
        out.write(WB.xlsx_bytes(GRID))


def test_archive_facade_catalog_and_convert(spark, tmpdir_path):
    build_tree(tmpdir_path)
    archive = Archive(spark, tmpdir_path)
    records = archive.microdata().collect()
    assert [r["name"] for r in records] == ["PNADC_012024_20250101.zip"]
    assert (records[0]["year"], records[0]["quarter"], records[0]["member"]) == (2024, 1, "PNADC_012024.txt")
    layouts = archive.layout_catalog().collect()
    assert len(layouts) == 2 and len({r["layout_id"] for r in layouts}) == 2
    matched = archive.catalog().collect()
    assert matched[0]["layout_id"] is not None and matched[0]["score"] >= 110
    variables = archive.layouts().orderBy("start").collect()
    assert [v["name"] for v in variables][:2] == ["uf", "v1008"]
    layout = Layout([Variable(v["name"], v["start"], v["width"]) for v in variables[:2]])
    out = os.path.join(tmpdir_path, "parquet")
    uri = [r["uri"] for r in archive.listing().filter(F.col("path").endswith("20250101.zip")).collect()]
    report = archive.convert(uri, layout, out).collect()
    assert report[0]["status"] == "converted" and report[0]["rows"] == 2
    assert sorted(r["uf"] for r in spark.read.parquet(report[0]["output"]).collect()) == [11, 12]


def test_incremental_convert_catalog(spark, tmpdir_path):
    build_tree(tmpdir_path)
    out = os.path.join(tmpdir_path, "parquet")
    first = Archive(spark, tmpdir_path).convert_catalog(out).first()
    assert (first["converted"], first["skipped"], first["unresolved"]) == (1, 0, 0)
    target = os.path.join(out, "trimestral", "2024", "PNADC_012024.parquet")
    assert sorted(r["uf"] for r in spark.read.parquet(target).collect()) == [11, 12]
    again = Archive(spark, tmpdir_path).convert_catalog(out).first()
    assert (again["converted"], again["skipped"], again["unresolved"]) == (0, 1, 0)
    subset = Archive(spark, tmpdir_path).convert_catalog(out, columns=["UF"]).first()
    assert (subset["converted"], subset["skipped"]) == (1, 0)


def test_remote_discovery_and_flat_index(spark, tmpdir_path):
    from wavefold.plans.sinks import flat_index, write_flat_index

    html = ('<a href="2024/">d</a><a href="PNADC_012024.zip">a</a><a href="PNADC_022023.zip">b</a>'
            '<a href="Documentacao/dicionario.zip">c</a><a href="Projecoes_Anteriores/x.zip">p</a>')
    pages = spark.createDataFrame([(1, "https://h.example/T/", html)], "page_id long, url string, html string")
    archive = Archive(spark, tmpdir_path)
    got = {r["path"] for r in archive.remote_files(pages, {"trimestral": "https://h.example/T/"}, years=[2024]).collect()}
    assert got == {"PNADC_012024.zip", "Documentacao/dicionario.zip"}
    index = flat_index(spark.createDataFrame([("b.parquet", 2), ("a.parquet", 1)], "name string, size long"))
    target = os.path.join(tmpdir_path, "index.json")
    write_flat_index(index, target)
    assert open(target).read().splitlines() == ['{"name":"a.parquet","size":1,"files":[]}',
                                                '{"name":"b.parquet","size":2,"files":[]}']


def test_facade_verify_and_panel(spark, tmpdir_path):
    import hashlib

    build_tree(tmpdir_path)
    archive = Archive(spark, tmpdir_path)
    rel = "originals/trimestral/2024/PNADC_012024_20250101.zip"
    data = open(os.path.join(tmpdir_path, rel), "rb").read()
    manifest = spark.createDataFrame(
        [("k1", rel, len(data), hashlib.sha256(data).hexdigest()), ("k2", rel, len(data), "0" * 64),
         ("k3", rel, len(data), None)], "key string, local string, size long, sha256 string")
    got = {r["key"]: r["status"] for r in archive.verify(manifest).collect()}
    assert got == {"k1": "ok", "k2": "failed", "k3": "unverifiable"}
    deep = {r["key"]: r["status"] for r in archive.verify(manifest, deep=True).collect()}
    assert deep["k3"] == "ok"
    cols = "ano int, trimestre int, upa int, v1008 int, v1016 int, v2003 int, v2007 int, v2008 int, v20081 int, v20082 int"
    paths = []
    for w in (1, 2):
        rows = [(2024, w, 100, 1, w, None, 1, 10, 5, 1980), (2024, w, 100, 1, w, None, 1, 10, 5, 1980)]
        p = os.path.join(tmpdir_path, f"wave{w}.parquet")
        spark.createDataFrame(rows, cols).coalesce(1).write.parquet(p)
        paths.append(p)
    summary = archive.panel(paths, "20241", os.path.join(tmpdir_path, "panel.parquet")).first()
    assert (summary["rows"], summary["persons"]) == (4, 2)
    wide = archive.panel(paths, "20241", os.path.join(tmpdir_path, "wide.parquet"), wide=True).first()
    assert (wide["rows"], wide["persons"]) == (2, 2)
    assert not [c for c in spark.read.parquet(os.path.join(tmpdir_path, "wide.parquet")).columns if c.startswith("_")]
    record = spark.read.json(os.path.join(tmpdir_path, "wide.parquet.json")).first()
    assert (record["rows"], record["wide"], record["panel_id"]) == (2, True, "20241")


def test_flat_layout_writes_index(spark, tmpdir_path):
    import json

    build_tree(tmpdir_path)
    out = os.path.join(tmpdir_path, "flat")
    result = Archive(spark, tmpdir_path, output_layout="flat").convert_catalog(out).first()
    assert result["converted"] == 1
    lines = open(os.path.join(out, "pnadc.microdados.dicionarios.json")).read().splitlines()
    record = json.loads(lines[0])
    assert record["name"] == "pnadc.microdados.trimestral.2024.1.parquet" and record["size"] > 0
    assert record["files"][0].endswith("PNADC_012024_20250101.zip")


def add_zip(root, name, payload, damage=False):
    data = bytearray(zipped(name, payload))
    if damage:
        data[len(data) // 2:len(data) // 2 + 30] = b"\xff" * 30
    with open(os.path.join(root, "originals", "trimestral", "2024", f"{name}.zip"), "wb") as out:
        out.write(bytes(data))


def zipped(name, payload):
    from wavefold.sources.archives import zip_bytes

    return zip_bytes([(f"{name}.txt", payload)])


def test_conversion_accounts_for_every_source(spark, tmpdir_path):
    """A damaged, undecodable, ill-typed or empty member never passes for a converted one, nor disappears."""
    build_tree(tmpdir_path)
    good = b"".join(b"%06d\n" % (110000 + i % 9999) for i in range(40_000))
    add_zip(tmpdir_path, "PNADC_022024", good[:140_000] + b"\xff" + good[140_000:])
    add_zip(tmpdir_path, "PNADC_032024", good, damage=True)
    add_zip(tmpdir_path, "PNADC_042024", b"")
    add_zip(tmpdir_path, "PNADC_012023", b"110001\nxx0002\n")
    out = os.path.join(tmpdir_path, "parquet")
    row = Archive(spark, tmpdir_path).convert_catalog(out).first()
    assert (row["converted"], row["skipped"], row["unresolved"]) == (2, 0, 3)
    reasons = {r.split(".zip: ")[0][-6:]: r.split(".zip: ")[1] for r in row["reasons"]}
    assert "while reading as utf-8" in reasons["022024"] and reasons["032024"].startswith("damaged archive")
    assert reasons["012023"] == "uf"
    base = os.path.join(out, "trimestral", "2024")
    assert sorted(os.listdir(base)) == ["PNADC_012024.parquet", "PNADC_042024.parquet"]
    empty = spark.read.parquet(os.path.join(base, "PNADC_042024.parquet"))
    assert empty.count() == 0 and empty.dtypes == spark.read.parquet(os.path.join(base, "PNADC_012024.parquet")).dtypes
    assert not [d for d in os.listdir(out) if d.startswith("_staging")]


def test_a_missing_output_is_converted_again(spark, tmpdir_path):
    build_tree(tmpdir_path)
    out = os.path.join(tmpdir_path, "parquet")
    assert Archive(spark, tmpdir_path).convert_catalog(out).first()["converted"] == 1
    target = os.path.join(out, "trimestral", "2024", "PNADC_012024.parquet")
    os.rename(target, os.path.join(tmpdir_path, "elsewhere"))
    again = Archive(spark, tmpdir_path).convert_catalog(out).first()
    assert (again["converted"], again["skipped"]) == (1, 0) and os.path.isdir(target)


def test_an_unreadable_dictionary_leaves_the_rest(spark, tmpdir_path):
    build_tree(tmpdir_path)
    doc_dir = os.path.join(tmpdir_path, "originals", "trimestral", "Documentacao")
    for name in os.listdir(doc_dir):
        with open(os.path.join(doc_dir, name), "wb") as out:
            out.write(WB.xlsx_bytes(GRID)[:200] if name.endswith(".xlsx") else zipped("x", b"y"))
    row = Archive(spark, tmpdir_path).convert_catalog(os.path.join(tmpdir_path, "parquet")).first()
    assert (row["converted"], row["unresolved"]) == (0, 1) and "dictionary" in row["reasons"][0]


def test_existing_outputs_are_not_read_again(spark, tmpdir_path):
    build_tree(tmpdir_path)
    archive, out = Archive(spark, tmpdir_path), os.path.join(tmpdir_path, "csv")
    layout = Layout([Variable("uf", 1, 2)])
    uri = [r["uri"] for r in archive.listing().filter(F.col("path").endswith("20250101.zip")).collect()]
    assert archive.convert(uri, layout, out, "csv").first()["status"] == "converted"
    again = archive.convert([*uri, "/nowhere/absent.zip"], layout, out, "csv").collect()
    assert sorted(r["status"] for r in again) == ["exists", "unresolved"]


def test_root_may_contain_the_originals_folder_name(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "originals", "mirror")
    os.makedirs(root)
    build_tree(root)
    paths = {r["path"] for r in Archive(spark, root).listing().collect()}
    assert "originals/trimestral/2024/PNADC_012024_20250101.zip" in paths


def test_unpack_records_its_state(spark, tmpdir_path):
    build_tree(tmpdir_path)
    add_zip(tmpdir_path, "PNADC_022024", b"110001\n" * 500, damage=True)
    actions = lambda: {r["archive"].rsplit("/", 1)[-1]: r["action"] for r in Archive(spark, tmpdir_path).unpack_plan().collect()}
    first = actions()
    assert set(first.values()) == {"process", "excluded"}
    archive = Archive(spark, tmpdir_path)
    results = archive.unpack(archive.unpack_plan()).collect()
    assert any(r["error"] for r in results) and any(r["output"] for r in results)
    second = actions()
    assert second["PNADC_012024_20250101.zip"] == "skip" and second["PNADC_022024.zip"] == "process"
    assert "extracted/trimestral/2024/PNADC_012024_20250101/PNADC_012024.txt" in {
        o for r in archive.unpack_state().collect() for o in r["outputs"]}
    archive.unpack(archive.unpack_plan())
    assert actions() == second


def test_discovery_feeds_the_sync_plan(spark, tmpdir_path):
    html = '<a href="PNADC_012024.zip">a</a><a href="PNADC_022024.zip">b</a>'
    pages = spark.createDataFrame([(1, "https://h.example/T/", html)], "page_id long, url string, html string")
    archive = Archive(spark, tmpdir_path)
    known = spark.createDataFrame([("https://h.example/T/PNADC_012024.zip", 7, "e", None)],
                                  "url string, size long, etag string, last_modified string")
    remote = archive.remote_files(pages, {"trimestral": "https://h.example/T/"}, metadata=known)
    manifest = spark.createDataFrame([], "key string, url string, size long, etag string, last_modified string, local string")
    local = spark.createDataFrame([("trimestral/PNADC_012024.zip", 7, True)], "key string, size long, readable boolean")
    got = {r["key"]: r["status"] for r in archive.sync_plan(remote, manifest, local).collect()}
    assert got == {"trimestral/PNADC_012024.zip": "adopt", "trimestral/PNADC_022024.zip": "download"}


def test_quarters_need_the_quarterly_survey(spark, tmpdir_path):
    import pytest

    build_tree(tmpdir_path)
    archive = Archive(spark, tmpdir_path)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    with pytest.raises(ValueError, match="trimestral"):
        archive.remote_files(pages, {"anual": "https://h.example/A/"}, quarters=[1])
    with pytest.raises(ValueError, match="trimestral"):
        archive.plan_conversion(os.path.join(tmpdir_path, "out"), scope="anual", quarters=[1])


def test_metadata_is_stored_and_read_back(spark, tmpdir_path):
    build_tree(tmpdir_path)
    archive = Archive(spark, tmpdir_path)
    table = archive.generate_metadata().collect()
    assert [r["path"].rsplit("/", 1)[-1] for r in table] == ["PNADC_012024_20250101.zip"] and table[0]["layout_id"]
    documents = {r["layout_id"]: r for r in spark.read.json(os.path.join(tmpdir_path, "metadata", "layouts")).collect()}
    own = documents[table[0]["layout_id"]]
    assert [v["name"] for v in own["variables"]] == ["uf", "v1008"] and own["variables"][0]["section"] == "identificação"
    assert len(own["source"]["dictionary_sha256"]) == 64
    single = os.path.join(tmpdir_path, "one.json")
    with open(single, "w", encoding="utf-8") as out:
        json.dump(Layout([Variable("uf", 1, 2)]).to_dict(), out)
    assert Layout.read(spark, single).names == ["uf"]


def test_unchanged_dictionaries_are_not_read_again(spark, tmpdir_path):
    """The second catalog opens no workbook, a changed one is read, and conversion takes the stored variables."""
    build_tree(tmpdir_path)
    actions = lambda: sorted((r["doc_id"], r["action"]) for r in Archive(spark, tmpdir_path).layout_store().select("doc_id", "action").collect())
    first = actions()
    assert first and {a for _, a in first} == {"parse"}
    Archive(spark, tmpdir_path).generate_metadata()
    assert actions() == [(doc, "keep") for doc, _ in first]
    again = Archive(spark, tmpdir_path)
    stored = spark.read.json(os.path.join(tmpdir_path, "metadata", "layouts")).orderBy("layout_id").collect()
    again.generate_metadata()
    assert spark.read.json(os.path.join(tmpdir_path, "metadata", "layouts")).orderBy("layout_id").collect() == stored
    made = again.convert_catalog(os.path.join(tmpdir_path, "out")).first()
    assert (made["converted"], made["unresolved"]) == (1, 0)
    books = [os.path.join(d, f) for d, _, fs in os.walk(tmpdir_path) for f in fs if f.lower().endswith(".zip") and "dicion" in f.lower()]
    with zipfile.ZipFile(books[0], "a") as changed:
        changed.writestr("nota.txt", "changed")
    assert sorted(a for _, a in actions()) == ["keep"] * (len(first) - 1) + ["parse"]


def test_lines_keep_their_order_over_blocks(spark, tmpdir_path):
    """A source of many part files: rows come back in line order, and the files follow the bytes."""
    from wavefold.operators.panel import ORDINAL, read_waves
    from wavefold.plans.convert import convert_lines

    layout = Layout([Variable("line_no", 1, 6), Variable("source", 7, 4)])  # names that the converter uses itself
    rows = [(f"{s}.txt", i + 1, f"{i + 1:06d}{s:4d}") for s in (1, 2) for i in range(300 * s)]
    lines = spark.createDataFrame(rows, "source string, line_no long, value string").repartition(7)
    for task_bytes, files in ((1100, {1: 3, 2: 6}), (11000, {1: 1, 2: 1})):
        target = os.path.join(tmpdir_path, f"out{task_bytes}")
        report = convert_lines(spark, lines, layout, target, task_bytes=task_bytes)
        assert {r["status"] for r in report.collect()} == {"converted"}
        for s in (1, 2):
            path = f"{target}/{s}.parquet"
            assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == files[s]
            (wave,) = read_waves(spark, [path])
            assert [r["line_no"] for r in wave.orderBy(*ORDINAL).collect()] == list(range(1, 300 * s + 1))


def test_small_blocks_share_tasks(spark, tmpdir_path, monkeypatch):
    """Many small blocks are far fewer tasks, whose files still follow the bytes and the line order."""
    from wavefold.operators.panel import ORDINAL, read_waves
    from wavefold.plans import convert as C

    monkeypatch.setattr(C, "CORE_BLOCKS", 1)
    layout = Layout([Variable("line_no", 1, 6), Variable("source", 7, 4)])
    rows = [(f"{s}.txt", i + 1, f"{i + 1:06d}{s:4d}") for s in (1, 2) for i in range(600 * s)]
    lines = spark.createDataFrame(rows, "source string, line_no long, value string").repartition(7)
    C.convert_lines(spark, lines, layout, f"{tmpdir_path}/out", task_bytes=110)
    tasks = set()
    for s in (1, 2):
        found = [f for f in os.listdir(f"{tmpdir_path}/out/{s}.parquet") if f.endswith(".parquet")]
        assert 60 * s <= len(found) <= 80 * s
        tasks |= {f.split("-")[1] for f in found}
        (wave,) = read_waves(spark, [f"{tmpdir_path}/out/{s}.parquet"])
        assert [r["line_no"] for r in wave.orderBy(*ORDINAL).collect()] == list(range(1, 600 * s + 1))
    assert len(tasks) <= 2 * spark.sparkContext.defaultParallelism + 1


def test_small_files_are_counted_as_they_are_written(spark, tmpdir_path, monkeypatch):
    """Many small files: lines are read twice (sizes, rows), what was written is not read again; types, nulls and faults stay."""
    from wavefold.operators.panel import ORDINAL, read_waves
    from wavefold.plans import convert as C

    def again(*args):
        raise AssertionError("the written files are opened again")

    monkeypatch.setattr(C, "CORE_BLOCKS", 1)
    monkeypatch.setattr(C, "_found", again)
    layout = Layout([Variable("line_no", 1, 6), Variable("small", 7, 2), Variable("price", 9, 15), Variable("text", 24, 20)])
    rows = [(f"{s}.txt", i + 1, f"{i + 1:06d}" + ("  " if i % 5 == 0 else "x1" if s == 3 and i % 7 == 3 else f"{i % 90:02d}")
             + f"{i / 4:015.2f}" + f"é{i}".ljust(20)) for s in (1, 2, 3) for i in range(200 * s)]
    seen = spark.sparkContext.accumulator(0)

    def counted(row):
        seen.add(1)
        return row

    lines = spark.createDataFrame(spark.sparkContext.parallelize(rows, 5).map(counted), "source string, line_no long, value string")
    target = f"{tmpdir_path}/out"
    report = {r["source"]: r for r in C.convert_lines(spark, lines, layout, target, task_bytes=600).collect()}
    assert seen.value == 2 * len(rows)
    assert {s: (r["status"], r["rows"], r["first_error"]) for s, r in report.items()} == {
        "1.txt": ("converted", 200, None), "2.txt": ("converted", 400, None), "3.txt": ("unresolved", 600, "small")}
    assert sorted(os.listdir(target)) == ["1.parquet", "2.parquet"]
    for s in (1, 2):
        files = os.listdir(f"{target}/{s}.parquet")
        assert 12 * s <= len(files) <= 25 * s and all(f.startswith("part-") and f.endswith(".zstd.parquet") for f in files)
        (wave,) = read_waves(spark, [f"{target}/{s}.parquet"])
        assert [f.dataType.simpleString() for f in wave.schema.fields][:4] == ["int", "tinyint", "double", "string"]
        assert [tuple(r)[:4] for r in wave.orderBy(*ORDINAL).collect()] == [
            (i + 1, None if i % 5 == 0 else i % 90, float(f"{i / 4:.2f}"), f"é{i}") for i in range(200 * s)]
    # What is there is not converted again, and does not count when blocks are dealt out.
    os.rename(f"{target}/2.parquet", f"{tmpdir_path}/kept")
    report = {r["source"]: r["status"] for r in C.convert_lines(spark, lines, layout, target, task_bytes=600).collect()}
    assert report == {"1.txt": "exists", "2.txt": "converted", "3.txt": "unresolved"}


def test_lines_of_one_number_keep_their_place(spark, tmpdir_path):
    from wavefold.operators.panel import ORDINAL, read_waves
    from wavefold.plans.convert import convert_lines

    rows = [("1.txt", i // 3, i, f"{i:06d}") for i in range(300)]
    lines = spark.createDataFrame(rows[::-1], "source string, line_no long, place long, value string").repartition(7, "place")
    convert_lines(spark, lines, Layout([Variable("place", 1, 6)]), f"{tmpdir_path}/out", task_bytes=700)
    (wave,) = read_waves(spark, [f"{tmpdir_path}/out/1.parquet"])
    assert [r["place"] for r in wave.orderBy(*ORDINAL).collect()] == list(range(300))


def test_write_whole_replaces(tmpdir_path):
    from wavefold.sources import archives as A

    for data in (b"first, and longer", b"second"):
        A.write_whole(f"{tmpdir_path}/a/b.parquet", data)
        assert os.listdir(f"{tmpdir_path}/a") == ["b.parquet"]
        assert open(f"{tmpdir_path}/a/b.parquet", "rb").read() == data


def test_blocks_go_to_the_lines(spark):
    """Lines are dealt out once, not sorted by source to meet their blocks."""
    from wavefold.plans.convert import in_blocks, plan_blocks

    lines = spark.createDataFrame([(f"{i % 3}.txt", i, "x" * 10, 0) for i in range(30)], "source string, line_no long, value string, offset long")
    blocks = plan_blocks(spark.createDataFrame([(f"{s}.txt", 110) for s in range(3)], "source string, bytes long")).withColumn("_src", F.col("source"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt, file_rows = in_blocks(lines, blocks)
        assert "SortMergeJoin" not in dealt._jdf.queryExecution().executedPlan().toString()
        assert (dealt.count(), file_rows) == (30, 0)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


ROOT_URL = "https://example.org/Trimestral/"


def update_inputs(spark):
    name = "PNADC_012024_20250101.zip"
    pages = spark.createDataFrame([(1, ROOT_URL + "2024/", f'<a href="{name}">a</a> <a href="PNADC_022024.zip">b</a>')],
                                  "page_id long, url string, html string")
    return pages, {"trimestral": ROOT_URL}, ROOT_URL + "2024/" + name


def test_update_goes_on_behind_its_last_step(spark, tmpdir_path, monkeypatch):
    build_tree(tmpdir_path)
    pages, roots, url = update_inputs(spark)
    size = os.path.getsize(os.path.join(tmpdir_path, "originals/trimestral/2024/PNADC_012024_20250101.zip"))
    metadata = spark.createDataFrame([(url, size, "e", "l")], "url string, size long, etag string, last_modified string")
    out = f"{tmpdir_path}/out"

    def broken(*args, **kw):
        raise RuntimeError("lost")

    # Catalog and conversion have tests of their own; here they only count.
    calls = []
    monkeypatch.setattr(Archive, "generate_metadata", lambda self: calls.append("catalog") or spark.range(3))
    monkeypatch.setattr(Archive, "standardize", broken)
    try:
        Archive(spark, tmpdir_path).update(pages, roots, out, metadata=metadata)
        raise AssertionError("the conversion should have failed")
    except RuntimeError as problem:
        assert str(problem) == "lost"
    with monkeypatch.context() as patch:
        patch.setattr(Archive, "standardize", lambda self, *args: calls.append(args) or (1, 0, 0))
        patch.setattr(Archive, "remote_files", broken)
        done = Archive(spark, tmpdir_path).update(pages, roots, out, metadata=metadata)
    assert done == {"sync": {"adopt": 1, "download": 1}, "cataloged": 3, "conversion": [1, 0, 0], "resumed": ["catalog", "sync"]}
    assert calls == ["catalog", (out, "parquet", "trimestral", None, None, None)]
    again = Archive(spark, tmpdir_path).update(pages, roots, out, metadata=metadata, convert=False)
    assert again == {"sync": {"unchanged": 1, "download": 1}, "cataloged": 3, "resumed": []}  # the adopted file is recorded
    recorded = Archive(spark, tmpdir_path).manifest().collect()
    assert [(r["key"], r["size"], r["adopted"]) for r in recorded] == [("trimestral/2024/PNADC_012024_20250101.zip", size, True)]


def test_single_conversion_is_recorded(spark, tmpdir_path):
    build_tree(tmpdir_path)
    archive = Archive(spark, tmpdir_path)
    layout = Layout([Variable("uf", 1, 2), Variable("v1008", 3, 4)])
    good = f"{archive.originals}/trimestral/2024/PNADC_012024_20250101.zip"
    gone = f"{archive.originals}/trimestral/2024/PNADC_999.zip"
    report = {r["source"]: r["status"] for r in archive.convert([good, gone], layout, f"{tmpdir_path}/one", columns=["UF"]).collect()}
    assert report[good] == "converted" and report[gone] == "unresolved"
    (row,) = archive.provenance(f"{tmpdir_path}/one").read().collect()
    assert (row["source"], row["rows"], row["columns"], row["variables"], row["text_values"]) == (good, 2, 1, ["uf"], False)
    assert row["output"].endswith(".parquet") and "/" not in row["output"]
    fingerprint = row["fingerprint"]
    assert fingerprint["source_size"] == os.path.getsize(good.removeprefix("file:")) and fingerprint["columns"] == "uf"
    assert len(fingerprint["layout_sha256"]) == 64 and fingerprint["source_name"] == "PNADC_012024_20250101.zip"


def test_listing_is_stored_in_path_order(spark, tmpdir_path):
    build_tree(tmpdir_path)
    archive = Archive(spark, tmpdir_path)
    before = sorted(r["path"] for r in archive.listing().collect())
    archive.write_listing()
    stored = spark.read.parquet(f"{tmpdir_path}/metadata/listing").select("path", "_metadata.file_name", "_metadata.row_index")
    assert [r["path"] for r in stored.orderBy("file_name", "row_index").collect()] == before
    assert sorted(r["path"] for r in archive.listing().collect()) == before
