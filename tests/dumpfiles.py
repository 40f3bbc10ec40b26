"""Small real dump files for the tests."""

import gzip
from pathlib import Path

MIDNIGHT = ["en Google 10 0", "en Google 5 0", "de Apple 7 123"]
ONE_O_CLOCK = [
    "en Google 3 0", "en google 99 0", "en Bing 50 0", "en.m Amazon 4 0", "short Google",
    "en Walmart x 0", "en  8 0",
]


def write_dump(folder: Path, name: str, lines: list[str]) -> Path:
    path = folder / name
    with gzip.open(path, "wt", encoding="utf-8") as dump:
        dump.writelines(line + "\n" for line in lines)
    return path


def write_day(folder: Path, day: str, hours=range(24)) -> None:
    """One line per hour: Google has hour + 1 views on en."""
    for hour in hours:
        write_dump(folder, f"pageviews-{day}-{hour:02d}0000.gz", [f"en Google {hour + 1} 0", "en Bing 9 0"])
