"""Deterministic identity: name-based ids, key hashes, fingerprints."""

from __future__ import annotations

import hashlib
import hmac

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the namespace of record ids.
NAMESPACE = "6f1b2c3d-4e5a-4b6c-8d7e-9f0a1b2c3d4e"


def uuid5(name: Column, namespace: str = NAMESPACE) -> Column:
    """Version-5 id of a name: SHA-1 over namespace and name with the version and variant bits set."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def entity_id(site_id: str, entity: str, key: Column | None = None) -> Column:
    """Id of an entity's row, or of a singleton record without a key."""
    parts = [F.lit(site_id), F.lit(entity)] + ([key.cast("string")] if key is not None else [])
    return uuid5(F.concat_ws("|", *parts))


def address_key(address: Column) -> Column:
    """Cache key of an address: a fixed-length hash behind a prefix."""
    return F.concat(F.lit("ip"), F.sha1(F.coalesce(address, F.lit("")).cast("binary")))


def short_sha256(text: Column, digits: int) -> Column:
    """The first hex digits of a SHA-256: 8 for hosts and batches, 12 for key fingerprints."""
    return F.substring(F.sha2(text.cast("binary"), 256), 1, digits)


def hmac_sha256(key: bytes, message: bytes) -> str:
    """Hex signature of a control message; made on the driver, where the key is."""
    return hmac.new(key, message, hashlib.sha256).hexdigest()


def base64url(data: Column) -> Column:
    """Unpadded URL-safe base64 of bytes."""
    return F.translate(F.base64(data), "+/=\r\n", "-_")
