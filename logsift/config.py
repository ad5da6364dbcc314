"""Detector configuration (frozen; used as literals inside plans)."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class DetectorConfig:
    # The rule detectors' defaults.
    suspicious_status_codes: tuple[int, ...] = (401, 403, 500, 502, 503)
    suspicious_http_methods: tuple[str, ...] = ("DELETE", "PUT")
    max_requests_per_ip: int = 100
    max_response_time_ms: int = 5000
    unusual_user_agents: tuple[str, ...] = ("sqlmap", "nikto", "nmap")
    geoblocking_countries: tuple[str, ...] = field(default_factory=tuple)


DEFAULT_CONFIG = DetectorConfig()
