"""Managed file folders: landing, inprogress, processed, quarantine, with a registry of contents.

Runs on the driver: it moves files and reads headers. Contents are hashed by Spark where
there are many (``checksums``).
"""

from __future__ import annotations

import codecs
import csv
import hashlib
import io
import re
import shutil
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.text import normalize_header
from sluice.operators.contract import Contract, ContractError, enforce, fingerprint, resolve_header

DELIMITERS = (",", ";", "|", "\t")
ON_DUPLICATE = ("SKIP", "REJECT", "REPROCESS_WITH_APPROVAL")


class IntakeError(ValueError):
    """A file that can't be taken in; the message starts with its code where it has one."""


@dataclass(frozen=True)
class FileRules:
    name_pattern: str | None = None
    extensions: tuple[str, ...] = ()
    min_bytes: int = 1
    max_bytes: int | None = None
    encoding: str = "utf-8"
    checksum_suffix: str | None = None
    delimiter: str = ","
    header: bool = True
    trailer_pattern: str | None = None
    on_duplicate: str = "SKIP"
    atomicity: str = "FILE"


@dataclass
class Staged:
    path: Path
    status: str
    reason: str = ""
    checksum: str = ""
    header: list[str] = field(default_factory=list)
    fingerprint: str = ""


def list_files(folder: Path) -> list[Path]:
    """Regular files by name; hidden and temporary ones (leading dot or underscore) are left out."""
    return sorted(p for p in folder.iterdir() if p.is_file() and p.name[0] not in "._") if folder.exists() else []


def move(path: Path, folder: Path) -> Path:
    """Moves a file; a number is added if its name is taken."""
    folder.mkdir(parents=True, exist_ok=True)
    target, n = folder / path.name, 1
    while target.exists():
        target = folder / f"{path.stem}_{n}{path.suffix}"
        n += 1
    shutil.move(path, target)
    return target


def sha256(path: Path) -> str:
    h = hashlib.sha256()
    with path.open("rb") as f:
        while part := f.read(1 << 20):
            h.update(part)
    return h.hexdigest()


def checksums(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, checksum, size_bytes) of many files, hashed by the executors."""
    files = spark.read.format("binaryFile").load(paths)
    return files.select("path", F.sha2("content", 256).alias("checksum"), F.col("length").alias("size_bytes"))


def last_line(path: Path, tail: int = 64 << 10) -> str:
    with path.open("rb") as f:
        f.seek(max(0, path.stat().st_size - tail))
        lines = f.read().decode("utf-8", "replace").rstrip("\r\n").splitlines()
    return lines[-1] if lines else ""


def check_encoding(path: Path, encoding: str, most: int = 1 << 20) -> None:
    """Decodes the first part of a file strictly; a character cut off at its end is no error."""
    try:
        decoder = codecs.getincrementaldecoder(encoding)("strict")
    except LookupError as e:
        raise IntakeError(f"HDR_012 encoding {encoding!r} is unknown") from e
    with path.open("rb") as f:
        try:
            decoder.decode(f.read(most), final=path.stat().st_size <= most)
        except UnicodeDecodeError as e:
            raise IntakeError(f"HDR_012 {path.name} isn't {encoding}") from e


def read_header(path: Path, delimiter: str = ",", encoding: str = "utf-8") -> list[str]:
    """The header's fields; refuses blank, badly quoted, repeated and wrongly delimited headers."""
    check_encoding(path, encoding)
    with path.open(encoding=encoding, newline="") as f:
        line = f.readline().rstrip("\r\n").lstrip("﻿")
    if not line.strip():
        raise IntakeError(f"HDR_010 {path.name} has no header")
    bare = re.sub(r'"(?:[^"]|"")*"', "", line)
    if '"' in bare:
        raise IntakeError(f"HDR_011 the header of {path.name} is badly quoted")
    fields = next(csv.reader(io.StringIO(line), delimiter=delimiter))
    if len(fields) == 1 and '"' not in line:
        other = [d for d in DELIMITERS if d != delimiter and line.count(d) >= 2]
        if other:
            raise IntakeError(f"HDR_009 the header of {path.name} seems to be delimited by {other[0]!r}")
    if any(not h.strip() for h in fields):
        raise IntakeError(f"HDR_010 {path.name} has a blank header")
    twice = sorted({h for h in fields if fields.count(h) > 1})
    if twice:
        raise IntakeError(f"HDR_002 {path.name} repeats header {', '.join(twice)}")
    return fields


def has_rows(path: Path, encoding: str = "utf-8") -> bool:
    with path.open(encoding=encoding, errors="replace") as f:
        next(f, None)
        return any(line.strip() for line in f)


def validate(path: Path, rules: FileRules, contract: Contract | None) -> Staged:
    """The file's state: VALIDATED, SKIPPED (header only) or FAILED with the reason."""
    out = Staged(path, "VALIDATED")
    try:
        size = path.stat().st_size
        if rules.name_pattern and not re.fullmatch(rules.name_pattern, path.name):
            raise IntakeError(f"{path.name} doesn't match {rules.name_pattern}")
        if rules.extensions and path.suffix.lower().lstrip(".") not in {e.lower().lstrip(".") for e in rules.extensions}:
            raise IntakeError(f"{path.name} has no allowed extension")
        if size < rules.min_bytes or (rules.max_bytes is not None and size > rules.max_bytes):
            raise IntakeError(f"{path.name} has {size} bytes")
        out.checksum = sha256(path)
        if rules.checksum_suffix:
            side = path.with_name(path.name + rules.checksum_suffix)
            if not side.exists() or side.read_text().split()[:1] != [out.checksum]:
                raise IntakeError(f"{path.name} differs from its checksum file")
        if rules.trailer_pattern and not re.fullmatch(rules.trailer_pattern, last_line(path)):
            raise IntakeError(f"{path.name} lacks its trailer")
        if rules.header:
            out.header = read_header(path, rules.delimiter, rules.encoding)
            if contract:
                resolution = resolve_header(contract, out.header)
                enforce(resolution.violations)
                out.fingerprint = fingerprint(resolution)
            else:
                out.fingerprint = hashlib.sha256("\u0001".join(map(normalize_header, out.header)).encode()).hexdigest()
            if not has_rows(path, rules.encoding):
                policy = contract.policy("header_only") if contract else "WARN_AND_SKIP"
                out.status, out.reason = ("FAILED" if policy == "FAIL" else "SKIPPED"), "HDR_013 header only"
    except (IntakeError, ContractError) as e:
        out.status, out.reason = "FAILED", str(e)
    return out


@dataclass
class Intake:
    """Takes files from landing (and left-overs of an interrupted run from inprogress) to inprogress.

    ``registry`` holds checksums of accepted contents; ``record`` is told (file, status, reason) before a
    file is moved, so that no move goes unrecorded. BATCH atomicity fails all files if one fails.
    """

    root: Path
    rules: FileRules = FileRules()
    contract: Contract | None = None
    registry: set[str] = field(default_factory=set)
    approved: set[str] = field(default_factory=set)
    record: object = print

    def stage(self) -> list[Staged]:
        if self.rules.on_duplicate not in ON_DUPLICATE:
            raise IntakeError(f"on_duplicate must be one of {', '.join(ON_DUPLICATE)}")
        side = self.rules.checksum_suffix
        found = [p for d in ("inprogress", "landing") for p in list_files(self.root / d) if not (side and p.name.endswith(side))]
        got = [validate(p, self.rules, self.contract) for p in found]
        seen: set[str] = set()
        for s in got:
            if s.status == "VALIDATED":
                if s.checksum in self.registry or s.checksum in seen:
                    self._duplicate(s)
                seen.add(s.checksum)
        if self.rules.atomicity == "BATCH" and any(s.status == "FAILED" for s in got):
            for s in got:
                if s.status == "VALIDATED":
                    s.status, s.reason = "HELD", "another file of the batch failed"
        for s in got:
            self.record((s.path.name, s.status, s.reason))
            folder = {"VALIDATED": "inprogress", "HELD": "landing", "FAILED": "quarantine"}.get(s.status, "skipped")
            if s.path.parent != self.root / folder:
                s.path = move(s.path, self.root / folder)
        return got

    def _duplicate(self, s: Staged) -> None:
        if self.rules.on_duplicate == "REPROCESS_WITH_APPROVAL" and s.checksum in self.approved:
            return
        s.status = "FAILED" if self.rules.on_duplicate == "REJECT" else "SKIPPED"
        s.reason = "the content was accepted before"

    def complete(self, staged: list[Staged]) -> None:
        """Registers the contents first and moves the files then: a crash between leaves no content that could load twice."""
        done = [s for s in staged if s.status == "VALIDATED"]
        for s in done:
            self.registry.add(s.checksum)
            self.record((s.path.name, "PROCESSED", ""))
        for s in done:
            s.path = move(s.path, self.root / "processed")
