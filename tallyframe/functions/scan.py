"""Scanner for secrets and private paths in text."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names and patterns of what must not be published.
PATTERNS = {
    "generic API key": r"(?i)(?:api[_-]?key|secret|token)\s*[:=]\s*['\"]?[A-Za-z0-9_\-]{20,}",
    "OpenAI-style key": r"\bsk-[A-Za-z0-9_\-]{20,}\b",
    "GitHub token": r"\b(?:ghp|github_pat)_[A-Za-z0-9_]{20,}\b",
    "private key": r"-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----",
    "Windows user path": r"(?i)[A-Za-z]:\\Users\\[^\\\s]+",
    "POSIX home path": r"/(?:Users|home)/[^/\s]+/",
}


def scan(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, finding): a row for each pattern that a text matches."""
    found = F.filter(F.array(*[F.when(F.col(text_col).rlike(p), F.lit(name)) for name, p in PATTERNS.items()]), lambda x: x.isNotNull())
    return df.select(F.col(id_col), F.explode_outer(found).alias("finding")).where("finding IS NOT NULL")


# Files that are not text, folders that are not looked into, and the size that a file may have.
BINARY = (".7z", ".docx", ".jpeg", ".jpg", ".mp4", ".pdf", ".png", ".tif", ".tiff", ".xls", ".xlsx", ".zip")
IGNORED = (".git", ".venv", "__pycache__", ".pytest_cache", ".ruff_cache")
LARGEST = 10 << 20


def file_findings(name: str, size: int, text: str | None, reviewed: str = "examples/synthetic/") -> list[str]:
    """What speaks against publishing a file of this name (with slashes), size and text (None: not text)."""
    base = name.rsplit("/", 1)[-1].lower()
    found = []
    if base == ".env" or (base.startswith(".env.") and base != ".env.example"):
        found.append(f"credential file is not publishable: {name}")
    if base == "settings.local.json":
        found.append(f"local agent permissions are not publishable: {name}")
    if size > LARGEST:
        found.append(f"file exceeds 10 MiB public-repo limit: {name}")
    if base.endswith(BINARY) and not name.startswith(reviewed):
        found.append(f"unreviewed binary/source artifact: {name}")
    if text is not None and name != ".env.example":
        found += [f"possible {label}: {name}" for label, pattern in PATTERNS.items() if re.search(pattern, text)]
    return found


def scan_folder(root: str) -> list[str]:
    """Findings of all files below a folder, in order and each once."""
    top, out = Path(root).resolve(), set()
    for path in top.rglob("*"):
        parts = path.relative_to(top).parts
        if not path.is_file() or any(p in IGNORED or p.endswith("venv") or p.startswith(".venv-") for p in parts):
            continue
        try:
            text = path.read_text(encoding="utf-8")
        except (UnicodeDecodeError, OSError):
            text = None
        out.update(file_findings("/".join(parts), path.stat().st_size, text))
    return sorted(out)
