"""Layout descriptions of output tables and their hashes, by which an existing table is checked before it is written to."""

from __future__ import annotations

#: Seed and factor of the hash, the segments' magic number and layout version, kinds, capacities and sizes.
SEED, FACTOR = 1469598103934665603, 1099511628211
MAGIC, LAYOUT_VERSION = 0x47434632, 2
BOARD, RING = 1, 2
RING_CAPACITY = 4096
LAYOUTS = {
    "bbo": "BookTickBoardSlot:seq8,exch_ns8,update_id8,bid_px4,bid_qty4,ask_px4,ask_qty4,kernel_T4,shm_T4,E_T4,lid2,price_scale1,qty_scale1,path_idx1",
    "depth": "DepthBoardSlot:seq8,exch_ns8,update_id8,lid2,price_scale1,qty_scale1,depth1,rsvd3,bid_px4xN,bid_qty4xN,ask_px4xN,ask_qty4xN;N=25",
    "trade": "TradeEntry:seq8|exch_ns8,px4,qty4,gid2,side1,pscale1,qscale1",
}


def schema_fnv(text: str) -> int:
    h = SEED
    for b in text.encode():
        h = (h ^ b) * FACTOR & (1 << 64) - 1
    return h
