"""Settings of a cleaning run. Defaults keep the established semantics; the flags under "compatibility" name its known oddities."""

from __future__ import annotations

from dataclasses import dataclass, field

from . import values


@dataclass(frozen=True)
class Config:
    run_id: str = "run"
    placeholder: str = values.PLACEHOLDER
    threshold: float = 0.7
    generic_mode: bool = False
    repair: bool = True
    batch_rows: int = 25
    dedup: bool = True
    strategy: str = "composite"  # email_only, phone_only, composite, all_fields, disabled
    dedup_fields: tuple[str, ...] = tuple(values.DEDUP_FIELDS)
    preserve_all_fields: bool = True
    max_file_bytes: int = values.MAX_FILE_BYTES
    malicious_hashes: frozenset[str] = field(default_factory=frozenset)

    # compatibility
    placeholder_in_key: bool = True  # a placeholder takes part in duplicate keys
    placeholder_present: bool = True  # and counts as a value when a row is routed
    placeholder_overwrites: bool = True  # and a newer duplicate's may overwrite a value
    greedy_honorifics: bool = True  # "Drake" loses its "Dr"
    strip_cjk: bool = True  # emoji removal also removes East Asian letters
    thousands_cut: bool = True  # "1,500" is 1.0
