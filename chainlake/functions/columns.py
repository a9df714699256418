"""Column helpers: hashes, byte order, varints, work, partition ids. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Script type codes and names, network magics (little-endian).
SCRIPT_TYPES = {0: "unknown", 1: "p2pk", 2: "p2pkh", 3: "p2sh", 4: "p2wpkh", 5: "p2wsh", 6: "p2tr", 7: "multisig", 8: "op_return", 9: "witness_unknown"}
MAGICS = {0xD9B4BEF9: "mainnet", 0x0709110B: "testnet3", 0x40CF030A: "signet", 0x283F161C: "testnet4", 0xDAB5BFFA: "regtest"}


def dsha256(data: Column) -> Column:
    """SHA-256 twice, as binary."""
    return F.unhex(F.sha2(F.unhex(F.sha2(data, 256)), 256))


def reversed_hex(hex_text: Column) -> Column:
    return F.concat_ws("", F.reverse(F.regexp_extract_all(hex_text, F.lit(".."), F.lit(0))))


def display_hex(hash_: Column) -> Column:
    """A stored (little-endian) hash as people write it."""
    return F.lower(reversed_hex(F.hex(hash_)))


def from_display_hex(text: Column) -> Column:
    """The stored form of a written hash; null unless it is 64 hex digits."""
    return F.when(text.rlike("^[0-9a-fA-F]{64}$"), F.unhex(reversed_hex(text)))


def le_uint(data: Column) -> Column:
    """Up to seven bytes as an unsigned little-endian integer."""
    return F.conv(reversed_hex(F.hex(data)), 16, 10).cast("long")


def le_int(data: Column, width: int) -> Column:
    """``width`` bytes, eight at most, as a signed little-endian integer."""
    high = F.conv(reversed_hex(F.hex(data)), 16, 10).cast("decimal(20,0)")
    top = F.lit(str(1 << 8 * width)).cast("decimal(20,0)")
    return F.when(high >= F.lit(str(1 << 8 * width - 1)).cast("decimal(20,0)"), high - top).otherwise(high).cast("long")


def varint_value(data: Column) -> Column:
    """The number at the front of the bytes; null if they end too soon or it has more than 63 bits. Longer forms than needed are accepted."""
    lead = F.conv(F.hex(F.substring(data, 1, 1)), 16, 10).cast("int")

    def tail(width: int) -> Column:
        part = F.substring(data, 2, width)
        return F.when(F.octet_length(part) == width, le_int(part, width))

    wide = tail(8)
    return F.when(F.octet_length(data) == 0, F.lit(None)).when(lead < 0xFD, lead.cast("long")).when(lead == 0xFD, le_uint(F.substring(data, 2, 2)) + 0 * tail(2)).when(lead == 0xFE, le_uint(F.substring(data, 2, 4)) + 0 * tail(4)).when(wide >= 0, wide)


def json_of(*columns: str) -> Column:
    """The columns as a JSON object, hashes (binary of 32 bytes) as people write them."""
    return F.to_json(F.struct(*[display_hex(F.col(c)).alias(c) for c in columns]))


def gib(size: Column) -> Column:
    """Bytes as text in GiB with two digits."""
    return F.format_string("%.2f GiB", size / F.lit(float(1 << 30)))


def network_of(magic: Column) -> Column:
    """The network that a little-endian magic names, else null."""
    names = F.create_map(*[x for code, name in MAGICS.items() for x in (F.lit(code).cast("long"), F.lit(name))])
    return F.try_element_at(names, magic.cast("long"))


def varint_length(value: Column) -> Column:
    """Bytes of the canonical variable-length encoding."""
    return F.when(value < 0xFD, 1).when(value <= 0xFFFF, 3).when(value <= 0xFFFFFFFF, 5).otherwise(9)


def varint_hex(value: Column) -> Column:
    def le(width: int) -> Column:
        return reversed_hex(F.lpad(F.hex(value), 2 * width, "0"))

    return F.when(value < 0xFD, le(1)).when(value <= 0xFFFF, F.concat(F.lit("FD"), le(2))).when(value <= 0xFFFFFFFF, F.concat(F.lit("FE"), le(4))).otherwise(F.concat(F.lit("FF"), le(8)))


def pad_hash(data: Column) -> Column:
    """32 bytes: zeros on the right, or cut."""
    return F.rpad(F.substring(data, 1, 32), 32, F.unhex(F.lit("00")))


def work_from_bits(bits: Column) -> Column:
    """Expected hashes for a compact target; 0 without a mantissa or with an exponent under 3."""
    exponent, mantissa = F.shiftrightunsigned(bits, 24), bits.bitwiseAND(F.lit(0x007FFFFF).cast("long"))
    return F.when((mantissa == 0) | (exponent < 3), 0.0).otherwise(F.pow(F.lit(2.0), 256 - (F.log2(mantissa.cast("double")) + 8 * (exponent - 3))))


def part_id(height: Column, blocks_per_part: int = 10_000) -> Column:
    return F.floor(height / blocks_per_part).cast("long")


def script_type_name(code: Column) -> Column:
    names = F.create_map(*[F.lit(x) for item in SCRIPT_TYPES.items() for x in item])
    return F.coalesce(F.try_element_at(names, code.cast("int")), F.lit("unknown"))
