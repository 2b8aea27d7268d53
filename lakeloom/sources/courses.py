"""Course structures: block trees in JSON documents and archives of XML."""

from __future__ import annotations

import hashlib
import io
import json
import mimetypes
import re
import tarfile
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BLOCKS = "course_id string, course_title string, course_start string, retrieved_at string, block_id string, block_index int, block_parent string, block_type string, block_title string, block_start string, block_due string, block_details string, block_content_hash string, course_content_hash string"
_XML = "course string, path string, block_type string, block_id string, display_name string, content_hash string, xml_path string, attributes map<string,string>, raw_xml string, edx_video_id string, duration string, max_attempts string, weight string, markdown string"
_COURSE = "course string, course_number string, run string, org string, title string, start string, end string, enrollment_start string, enrollment_end string, instructor_info string, self_paced boolean"
_POLICY = "course string, advanced_modules string, discussions_settings string, display_coursenumber string, self_paced boolean, tabs string, tags string"
_SIGNATORY = "course string, certificate_id string, fields map<string,string>"
_BUNDLE = "course string, data_version string, file_count int, files array<struct<path:string,mime_type:string,size_bytes:bigint>>"
#: Folders of an archive that hold no blocks.
EXCLUDED = ("drafts", "assets", "static", "policies", "about", "info", "tabs")


def _digest(value: object) -> str:
    return hashlib.sha256(json.dumps(value).encode()).hexdigest()


def walked(blocks: dict[str, dict], root: str | None) -> Iterator[str]:
    """Blocks in depth-first order from the root; children that the document lacks, and blocks met before, are passed over."""
    stack, seen = [root], set()
    while stack:
        block = stack.pop()
        if block in seen or block not in blocks:
            continue
        seen.add(block)
        yield block
        stack += reversed(blocks[block].get("children") or [])


def _unnested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in _BLOCKS.split(", ")]
    for batch in batches:
        rows = []
        for course, text, retrieved in zip(batch["course_id"], batch["structure"], batch["retrieved_at"], strict=True):
            try:
                blocks = json.loads(text or "{}")
            except ValueError:
                continue
            if not isinstance(blocks, dict):
                continue
            root = next((k for k, b in blocks.items() if b.get("category") == "course"), None)
            top = (blocks[root].get("metadata") or {}) if root is not None else {}
            place = {block: i for i, block in enumerate(walked(blocks, root), 1)}
            parent = {c: k for k, b in blocks.items() for c in b.get("children") or []}
            whole = _digest(blocks)
            for block, b in blocks.items():
                meta = b.get("metadata") or {}
                rows.append((course, top.get("display_name"), top.get("start"), retrieved, block, place.get(block, 0), parent.get(block), b.get("category"), meta.get("display_name"), meta.get("start"), meta.get("due"), json.dumps(b), _digest(b), whole))
        yield pd.DataFrame(rows, columns=names)


def unnested_structures(documents: DataFrame) -> DataFrame:
    """One row for each block of each course document (course_id, structure, and retrieved_at if there is one).

    ``block_index`` counts from 1 in depth-first order from the course block; blocks that it does not lead to have 0.
    A document is one course, so rows of a task are bounded by it. Text that is no JSON object gives none.
    """
    if "retrieved_at" not in documents.columns:
        documents = documents.withColumn("retrieved_at", F.lit(None).cast("string"))
    return documents.select("course_id", "structure", F.col("retrieved_at").cast("string").alias("retrieved_at")).mapInPandas(_unnested, _BLOCKS)


@dataclass
class Archive:
    """An opened archive: its course and its files by their path below the root."""

    tar: tarfile.TarFile
    members: dict[str, tarfile.TarInfo]
    root: ET.Element

    @property
    def course(self) -> str:
        return f"course-v1:{self.root.get('org')}+{self.root.get('course')}+{self.root.get('url_name')}"

    def read(self, name: str) -> bytes:
        return self.tar.extractfile(self.members[name]).read()


def _read(spark: SparkSession, path: str, schema: str, rows: Callable[[str, Archive], Iterable[tuple]]) -> DataFrame:
    """What ``rows`` finds in each archive at ``path``, one archive a task at a time."""
    names = [c.split()[0] for c in re.sub(r"<.*>", "", schema).split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for where, content in zip(batch["path"], batch["content"], strict=True):
                with tarfile.open(fileobj=io.BytesIO(content)) as tar:
                    members = {m.name.partition("/")[2]: m for m in tar.getmembers() if m.isfile()}
                    if "course.xml" not in members:
                        raise ValueError(f"{where} has no course.xml")
                    archive = Archive(tar, members, ET.fromstring(tar.extractfile(members["course.xml"]).read()))
                    yield pd.DataFrame(list(rows(where, archive)), columns=names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, schema)


def _blocks(path: str, archive: Archive) -> Iterator[tuple]:
    for name in sorted(archive.members):
        folder, _, file = name.partition("/")
        if not file.endswith(".xml") or "/" in file or folder in EXCLUDED:
            continue
        data = archive.read(name)
        try:
            block = ET.fromstring(data)
        except ET.ParseError:
            continue
        asset = block.find("video_asset")
        duration = None if folder != "video" else "0.0" if asset is None else asset.get("duration")
        own = [block.get(a) for a in ("edx_video_id",)] if folder == "video" else [None]
        problem = [block.get(a) for a in ("max_attempts", "weight", "markdown")] if folder == "problem" else [None] * 3
        yield archive.course, path, folder, block.get("url_name") or file[:-4], block.get("display_name"), hashlib.sha256(data).hexdigest(), name, dict(block.attrib), data.decode("utf-8", "replace"), *own, duration, *problem


def read_course_archives(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of course archives (tar of XML): one row for each file of a block folder; an archive without course.xml is an error.

    A block is of its folder's type, named by its url_name or else by its file. All attributes and the text are kept beside
    the fields of videos and problems. Files that are no XML are passed over.
    """
    return _read(spark, path, _XML, _blocks)


def read_course_metadata(spark: SparkSession, path: str) -> DataFrame:
    """One row for each archive: its course, and what the file of its run says of it, if there is one."""

    def rows(_: str, archive: Archive) -> Iterator[tuple]:
        run = archive.root.get("url_name")
        name = f"course/{run}.xml"
        told = ET.fromstring(archive.read(name)) if name in archive.members else ET.Element("course")
        fields = [told.get(a) for a in ("display_name", "start", "end", "enrollment_start", "enrollment_end", "instructor_info")]
        yield archive.course, archive.root.get("course"), run, archive.root.get("org"), *fields, bool(told.get("self_paced"))

    return _read(spark, path, _COURSE, rows)


def _policies(archive: Archive) -> Iterator[dict]:
    """The course entries of the policy files of the archive's run."""
    for name in sorted(archive.members):
        if name.startswith(f"policies/{archive.root.get('url_name')}/"):
            found = json.loads(archive.read(name))
            yield from (v for k, v in found.items() if k.startswith("course/"))


def read_policies(spark: SparkSession, path: str) -> DataFrame:
    """One row for each course policy of the archives' runs; lists and objects as JSON text."""

    def rows(_: str, archive: Archive) -> Iterator[tuple]:
        for p in _policies(archive):
            as_json = lambda key, default, p=p: json.dumps(p.get(key, default))
            yield archive.course, as_json("advanced_modules", []), as_json("discussions_settings", {}), p.get("display_coursenumber", ""), p.get("self_paced"), as_json("tabs", []), as_json("tags", [])

    return _read(spark, path, _POLICY, rows)


def read_signatories(spark: SparkSession, path: str) -> DataFrame:
    """One row for each signatory of each certificate in the policies; its fields as text."""

    def rows(_: str, archive: Archive) -> Iterator[tuple]:
        for p in _policies(archive):
            for certificate in p.get("certificates", {}).get("certificates", []):
                for signatory in certificate.get("signatories", []):
                    yield archive.course, str(certificate.get("id")), {k: v if isinstance(v, str) else json.dumps(v) for k, v in signatory.items()}

    return _read(spark, path, _SIGNATORY, rows)


def read_asset_bundles(spark: SparkSession, path: str) -> DataFrame:
    """One row for each archive: a digest of its static files' contents in order of path, and a list of them."""

    def rows(_: str, archive: Archive) -> Iterator[tuple]:
        names = [n for n in sorted(archive.members) if n.startswith("static/") and not n.endswith(".xml")]
        whole, files = hashlib.sha256(), []
        for name in names:
            data = archive.read(name)
            whole.update(data)
            files.append({"path": name, "mime_type": mimetypes.guess_type(name)[0] or "application/octet-stream", "size_bytes": len(data)})
        yield archive.course, whole.hexdigest(), len(files), files

    return _read(spark, path, _BUNDLE, rows)


def flattened_json(text: str, separator: str = "__"):
    """A column: the JSON object's leaves by the path of their keys, as a map of strings."""

    @F.pandas_udf("map<string,string>")
    def flat(texts: pd.Series) -> pd.Series:
        def leaves(prefix: str, value: object, out: dict[str, str]) -> dict[str, str]:
            if isinstance(value, dict):
                for k, v in value.items():
                    leaves(f"{prefix}{separator}{k}" if prefix else k, v, out)
            else:
                out[prefix] = value if isinstance(value, str) else json.dumps(value)
            return out

        found = []
        for t in texts:
            try:
                value = json.loads(t) if t else None
            except ValueError:
                value = None
            found.append(leaves("", value, {}) if isinstance(value, dict) else None)
        return pd.Series(found, dtype="object")

    return flat(F.col(text))
