"""Edits of VCF header metadata (driver-side: a header is a few kB)."""

from __future__ import annotations

import copy

from lociframe.sources.vcf import VcfHeader, parse_header_lines

# FILTER lines added after a sample merge.
MERGE_FILTERS = {
    "LowQual": "Low quality",
    "NO_HQ_GENOTYPES": "Sites with this filter do not have any genotypes that are considered high quality",
}


def set_field(header: VcfHeader, section: str, fid: str, number: str | None = None,
              vtype: str | None = None, description: str | None = None) -> VcfHeader:
    """Declare or overwrite one INFO / FORMAT / FILTER entry."""
    h = copy.deepcopy(header)
    target = {"INFO": h.info, "FORMAT": h.format, "FILTER": h.filter}[section.upper()]
    target[fid] = {"Number": number, "Type": vtype, "Description": description}
    return h


def append_filter_lines(header: VcfHeader, lines: list[str]) -> VcfHeader:
    """Add ``##FILTER`` lines (e.g. read from a file); an id already declared
    keeps its first definition."""
    h = copy.deepcopy(header)
    extra = parse_header_lines(lines)
    for fid, d in extra.filter.items():
        h.filter.setdefault(fid, d)
    return h


def add_merge_filters(header: VcfHeader) -> VcfHeader:
    """The two FILTER declarations a merged call set carries."""
    h = header
    for fid, desc in MERGE_FILTERS.items():
        if fid not in h.filter:
            h = set_field(h, "FILTER", fid, description=desc)
    return h
