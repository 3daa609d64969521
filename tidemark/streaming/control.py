"""Control commands: the chain of gates that a signed request passes, and actions by name."""

from __future__ import annotations

import hmac
import json
import time
from collections.abc import Callable, Mapping
from typing import Any

from tidemark.functions.identity import hmac_sha256

# Limits of the chain.
SKEW_SECONDS = 300
REPLAY_SECONDS = 900
MOST_BYTES = 65_536

Answer = tuple[int, dict[str, Any]]


class Control:
    """Handles commands for one site; `seen` maps command ids to when they were applied."""

    def __init__(self, site_id: str, secret: str, actions: Mapping[str, Callable[[dict], Answer]], seen: dict[str, float] | None = None, now: Callable[[], float] = time.time):
        self.site_id, self.secret, self.actions, self.now = site_id, secret, dict(actions), now
        self.seen = {} if seen is None else seen

    def handle(self, body: bytes, signature: str) -> Answer:
        error = lambda code, detail: (code, {"status": "error", "detail": detail})
        if not self.secret:
            return error(503, "not_configured")
        if not body or len(body) > MOST_BYTES:
            return error(400, "bad_request")
        if not hmac.compare_digest(hmac_sha256(self.secret.encode(), body), signature):
            return error(403, "forbidden")
        try:
            said = json.loads(body)
        except ValueError:
            said = None
        if not isinstance(said, dict):
            return error(400, "bad_request")
        at = said.get("timestamp", 0)
        if not isinstance(at, (int, float)) or at <= 0 or abs(self.now() - at) > SKEW_SECONDS:
            return error(408, "stale")
        if not self.site_id or str(said.get("site_id", "")) != self.site_id:
            return error(409, "site_mismatch")
        command = str(said.get("command_id", ""))
        if not command:
            return error(400, "bad_request")
        for old in [k for k, t in self.seen.items() if self.now() - t > REPLAY_SECONDS]:
            del self.seen[old]
        if command in self.seen:
            return 200, {"status": "ok", "detail": "already_applied", "command_id": command}
        action = self.actions.get(str(said.get("action", "")))
        if action is None:
            return error(400, "unknown_action")
        payload = said.get("payload")
        code, answer = action(payload if isinstance(payload, dict) else {})
        if code < 400:
            self.seen[command] = self.now()
        return code, {**answer, "command_id": command}
