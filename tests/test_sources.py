import gzip

import pytest

from quern.sources import archive, jsonl, settings
from quern.streaming.ingest import ingest_available

LINES = [b'\xef\xbb\xbf{"word": " a ", "pos": 5}\r', b"", b"  ", b"{bad", b"[1, 2]", b"\xff\xfe", b'{"word": "b", "lang_code": "en"}']


@pytest.mark.parametrize("zipped", [False, True])
def test_scan(spark, tmp_path, zipped):
    path = tmp_path / ("a.jsonl.gz" if zipped else "a.jsonl")
    with (gzip.open if zipped else open)(path, "wb") as f:
        f.write(b"\n".join(LINES))
    got = {r["source_line"]: r for r in jsonl.scan_file(spark, str(path)).collect()}
    assert sorted(got) == [1, 4, 5, 6, 7]
    assert (got[1]["kind"], got[1]["word"], got[1]["pos"]) == ("record", "a", None)
    assert [got[k]["kind"] for k in (4, 5, 6, 7)] == ["invalid_json", "non_object_json", "invalid_utf8", "record"]
    assert got[5]["detail"] == "Expected object, got list" and got[4]["json_text"] == "{bad" and got[6]["json_text"] is None
    offsets = [got[k]["source_byte_offset"] for k in sorted(got)]
    assert offsets == sorted(offsets)


def test_line_numbers_over_splits(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.jsonl").write_text("".join(f'{{"word": "w{k}_{i}"}}\n' for i in range(50 + k)))
    got = jsonl.scan_file(spark, str(tmp_path)).collect()
    assert sorted(r["source_line"] for r in got) == list(range(1, 154))


def test_archives(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"hello")
    (tmp_path / "b.gz").write_bytes(gzip.compress(b"hello"))
    found = archive.register(str(tmp_path / "a.txt"), str(tmp_path / "kept"))
    assert found.size == 5 and found.path.endswith("kept/a.txt") and found.compression is None
    assert archive.fingerprints(spark, found.path).first()["sha256"] == found.sha256 == archive.fingerprint(found.path)
    out = archive.unpack(str(tmp_path / "b.gz"), str(tmp_path / "b"))
    assert open(out, "rb").read() == b"hello" and archive.compression("x.gz") == "gzip"
    assert archive.name_of("https://x.org/d/e.gz?y=1") == "e.gz"
    with pytest.raises(FileNotFoundError):
        archive.register(str(tmp_path / "none"))
    with pytest.raises(ValueError):
        archive.name_of("https://x.org/")


def test_settings(tmp_path):
    one = {"LLM_API": "a", "LLM_MODEL": "m", "LLM_KEY": "k"}
    assert settings.providers(one) == [settings.Provider("a", "m", "k")]
    pool = '[{"api": "a", "model": "m", "key": "k", "rpm": 5}]'
    assert settings.providers({"LLM_POOL": pool})[0].rpm == 5
    for bad in ("[]", '[{"api": "a"}]', '[{"api": "a", "model": "m", "key": "k", "odd": 1}]', '[{"api": "a", "model": "m", "key": "k", "rpm": 0}]', '[{"api": "a", "model": "m", "key": "k", "rpm": true}]'):
        with pytest.raises(ValueError):
            settings.providers({"LLM_POOL": bad})
    with pytest.raises(ValueError):
        settings.providers({})
    (tmp_path / ".env").write_text("# x\nexport A='b c'\nB=2\n\n")
    assert settings.read_dotenv(str(tmp_path / ".env")) == {"A": "b c", "B": "2"}


def test_streaming_ingest_reads_files_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    args = [str(tmp_path / d) for d in ("in", "raw", "bad", "state")]
    for k in range(2):
        (tmp_path / "in" / f"{k}.jsonl").write_text('{"word": "a"}\n{bad\n')
        ingest_available(spark, *args)
    ingest_available(spark, *args)
    assert spark.read.parquet(args[1]).count() == 2 and spark.read.parquet(args[2]).count() == 2
