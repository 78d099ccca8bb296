"""Requests to vision services: pacing, cooldowns, retries and fallback, with clock and transport as parameters.

Nothing here opens a connection: ``send`` is given, and so are ``now`` and ``sleep``.
A service's requests are made one at a time, so that a cooldown that one of them
learns holds for the next. In Spark, the rows of one service belong in one partition.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from email.utils import parsedate_to_datetime
from typing import NamedTuple


class Response(NamedTuple):
    status: int
    headers: dict
    body: str


class Unavailable(Exception):
    """Why a service did not answer; it never holds addresses, keys or bodies."""


def _error(response: Response | None) -> dict:
    """The error that an answer's body tells of, {} if it has none of the usual shape."""
    try:
        body = json.loads(response.body) if response else None
    except ValueError:
        body = None
    found = body.get("error") if isinstance(body, dict) else None
    return found if isinstance(found, dict) else {}


def _details(response: Response | None, key: str) -> list:
    """What the details of an error hold under a key, in order."""
    details = _error(response).get("details")
    return [d[key] for d in details if isinstance(d, dict) and key in d] if isinstance(details, list) else []


def _violations(response: Response | None) -> list[dict]:
    return [v for some in _details(response, "violations") if isinstance(some, list) for v in some if isinstance(v, dict)]


def long_quota(response: Response) -> str | None:
    """'daily' or 'zero' where waiting will not help; the first violation that says so decides, then the message."""

    def kind(v: dict) -> str | None:
        name = (str(v.get("quotaId", "")) + str(v.get("quotaMetric", ""))).lower().replace("_", "")
        return "daily" if "perday" in name else "zero" if str(v.get("quotaValue", "")) == "0" else None

    said = "daily" if re.search(r"\b(per day|daily quota)\b", str(_error(response).get("message")).lower()) else None
    return next(filter(None, map(kind, _violations(response))), said)


def names_model(response: Response | None) -> bool:
    """Whether a quota is the model's own: there are violations, and every one names a model."""
    named = [isinstance(d := v.get("quotaDimensions"), dict) and bool(d.get("model")) for v in _violations(response)]
    return bool(named) and all(named)


def _number(value) -> list[float]:
    """[the value], or [] if it is no finite number; not below 0."""
    try:
        return [max(0.0, x)] if math.isfinite(x := float(value)) else []
    except (TypeError, ValueError):
        return []


def _until(header: str, wall: float) -> list[float]:
    try:
        return _number(parsedate_to_datetime(header).timestamp() - wall)
    except (TypeError, ValueError, OverflowError):
        return []


def _duration(value) -> list[float]:
    """Of "12.5s", or of {seconds, nanos}."""
    if isinstance(value, dict):
        parts = [_number(value.get(k, 0)) for k in ("seconds", "nanos")]
        return [parts[0][0] + parts[1][0] / 1e9] if all(parts) else []
    return _number(value[:-1]) if isinstance(value, str) and value[-1:] == "s" else []


def retry_delay(response: Response | None, attempt: int, wall: float) -> float:
    """Seconds to wait: the longest that header, details or message ask for, else two to the attempt, 60 at most."""
    header = response.headers.get("Retry-After", "") if response else ""
    asked = _number(header) or _until(header, wall)
    asked += [x for value in _details(response, "retryDelay") for x in _duration(value)]
    asked += [x for value in re.findall(r"(?i)retry\s+(?:in|after)\s+([\d.]+)\s*s", str(_error(response).get("message"))) for x in _number(value)]
    return max(asked, default=min(60.0, 2.0 ** min(attempt, 6)))


@dataclass
class Client:
    """send(service, model, payload) gives a Response or raises OSError; per_minute: requests to
    a service; budget: seconds of waiting for one request; retries: beyond the first attempt."""

    send: Callable[[str, str, dict], Response]
    now: Callable[[], float]
    sleep: Callable[[float], None]
    wall: Callable[[], float]
    per_minute: int = 10
    retries: int = 2
    budget: float = 180.0
    next_request: dict = field(default_factory=dict)
    cooldown: dict = field(default_factory=dict)
    disabled: dict = field(default_factory=dict)

    def wait(self, seconds: float) -> None:
        """In pieces that can be interrupted."""
        while seconds > 0:
            self.sleep(min(seconds, 30.0))
            seconds -= 30.0

    def pace(self, service: str) -> None:
        while (delay := self.next_request.get(service, self.now()) - self.now()) > 0:
            self.wait(delay)
        self.next_request[service] = self.now() + 60.0 / max(1, self.per_minute)

    def cool(self, scope, seconds: float) -> None:
        self.cooldown[scope] = max(self.cooldown.get(scope, 0.0), self.now() + seconds)

    def off(self, scope, why: str):
        self.disabled[scope] = why
        return Unavailable(why)

    def post(self, service: str, model: str, payload: dict) -> str:
        """The body of an answer, after retries; Unavailable where there is none."""
        own = (service, model)
        for scope in (service, own):
            if scope in self.disabled:
                raise Unavailable(self.disabled[scope])
            if (left := self.cooldown.get(scope, 0.0) - self.now()) > 0:
                raise Unavailable(f"cooling down for {left:.1f} s")
        waited = 0.0
        for attempt in range(max(0, self.retries) + 1):
            self.pace(service)
            response, scope = None, own
            try:
                response = self.send(service, model, payload)
            except OSError as error:
                why, delay = type(error).__name__, retry_delay(None, attempt, self.wall())
            else:
                if 200 <= response.status < 300:
                    return response.body
                why = f"HTTP {response.status}"
                if response.status in (401, 403):
                    raise self.off(service, f"{why}: check access")
                if response.status == 404:
                    raise self.off(own, f"{why}: no such model")
                if response.status != 429 and response.status < 500 or response.status >= 600:
                    raise Unavailable(why)
                if response.status == 429:
                    scope = own if names_model(response) else service
                    if quota := long_quota(response):
                        raise self.off(scope, f"{why}: {quota} quota")
                delay = retry_delay(response, attempt, self.wall())
                self.cool(scope, delay)
            if attempt >= self.retries or waited + delay > self.budget:
                self.cool(scope, max(delay, 30.0))
                raise Unavailable(f"{why}: no retries left")
            self.wait(delay)
            waited += delay
        raise AssertionError("unreachable")

    def first_answer(self, services: list[tuple[str, list[str]]], payload: dict, read: Callable[[str, str], dict]) -> tuple[dict | None, list[str]]:
        """(what ``read(service, body)`` makes of the first good answer, or None; what failed before). Models in order, then the next service."""
        errors = []
        for service, models in services:
            for model in models:
                try:
                    return {**read(service, self.post(service, model, payload)), "source": "ai", "provider": f"{service}:{model}"}, errors
                except (Unavailable, ValueError, KeyError, IndexError, TypeError) as error:
                    errors.append(f"{service}/{model}: {error if isinstance(error, Unavailable) else type(error).__name__}")
                    if service in self.disabled or self.cooldown.get(service, 0.0) > self.now():
                        break
        return None, errors
