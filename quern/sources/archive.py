"""Local archives: registration, compression, fingerprints and unpacking. There is no network; a source is a path."""

from __future__ import annotations

import gzip
import hashlib
import shutil
from dataclasses import dataclass
from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.export import install

CHUNK = 1 << 20


@dataclass(frozen=True)
class Snapshot:
    path: str
    sha256: str
    size: int
    compression: str | None
    mode: str


def compression(path: str) -> str | None:
    return "gzip" if path.endswith(".gz") else None


def name_of(url: str) -> str:
    """The file name of a URL or path."""
    name = Path(urlparse(url).path).name
    if not name:
        raise ValueError(f"no file name in {url!r}")
    return name


def fingerprint(path: str) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        while part := f.read(CHUNK):
            digest.update(part)
    return digest.hexdigest()


def fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of files wherever Spark reads them, hashed by executors."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def register(source: str, folder: str | None = None, overwrite: bool = False) -> Snapshot:
    """A local file as a snapshot; copied to `folder` if that is another place."""
    path = Path(source)
    if not path.is_file():
        raise FileNotFoundError(source)
    if folder and (target := Path(folder) / path.name).resolve() != path.resolve():
        if overwrite or not target.exists():
            install(str(target), lambda part: shutil.copyfile(path, part))
        path = target
    return Snapshot(str(path), fingerprint(str(path)), path.stat().st_size, compression(str(path)), "register_local")


def unpack(source: str, target: str, overwrite: bool = False) -> str:
    """The text of a gzip file as a plain one."""
    if Path(target).exists() and not overwrite:
        return target

    def fill(part: str) -> None:
        with gzip.open(source, "rb") as a, open(part, "wb") as b:
            shutil.copyfileobj(a, b, CHUNK)

    install(target, fill)
    return target
