"""Declared schemas of the market tables; columns are addressed by name everywhere."""

from __future__ import annotations

from pyspark.sql import types as T

_T = {"ts": T.TimestampType(), "s": T.StringType(), "j": T.LongType(), "f": T.DoubleType(), "b": T.BooleanType(), "i": T.IntegerType(), "d": T.DateType()}


def fields(spec: str) -> T.StructType:
    """``name:kind`` words; kinds are ts, s(tring), j (long), f (double), b(oolean), i(nt), d(ate)."""
    return T.StructType([T.StructField(n, _T[k], k != "b") for n, k in (w.split(":") for w in spec.split())])


def extend(schema: T.StructType, *names: str) -> T.StructType:
    """The schema with further long columns, as each stage of the live pipeline stamps its own."""
    return T.StructType([*schema.fields, *(T.StructField(n, T.LongType()) for n in names)])


_STAMPS = "exchEventTimeMs:j exchTradeTimeMs:j fhRecvTimeUtcNs:j fhParseUs:j fhSendUs:j fhSeqNo:j"
SIDES = [f"{side}{what}{i}" for side in ("bid", "ask") for what in ("Price", "Qty") for i in range(1, 6)]

TRADE = fields(f"time:ts sym:s tradeId:j price:f qty:f buyerIsMaker:b {_STAMPS}")
AGG_TRADE = fields(f"time:ts sym:s aggTradeId:j firstTradeId:j lastTradeId:j price:f qty:f buyerIsMaker:b {_STAMPS}")
QUOTE = fields("time:ts sym:s " + " ".join(f"{c}:f" for c in SIDES) + " isValid:b exchEventTimeMs:j fhRecvTimeUtcNs:j fhParseUs:j fhSendUs:j fhSeqNo:j")
HEALTH = fields("time:ts handler:s startTimeUtc:ts uptimeSec:j msgsReceived:j msgsPublished:j lastMsgTimeUtc:ts lastPubTimeUtc:ts connState:s symbolCount:i")
POSITION = fields("time:ts sym:s side:i qty:f tradedPrice:f")
ROUTER_STAMPS, STORE_STAMPS, WRITER_STAMPS = ("tpRecvTimeUtcNs", "tpSeqNo"), ("rdbRecvTimeUtcNs",), ("wdbRecvTimeUtcNs",)

SPOT_ARCHIVE = fields("exchTradeTs:ts exchTradeTimeMs:j sym:s tradeId:j price:f qty:f buyerIsMaker:b")
AGG_ARCHIVE = fields("exchTradeTs:ts exchTradeTimeMs:j sym:s aggTradeId:j firstTradeId:j lastTradeId:j price:f qty:f buyerIsMaker:b")
FILL_ARCHIVE = fields("exchTradeTs:ts exchTradeTimeMs:j sym:s tradeId:j price:f qty:f quoteQty:f buyerIsMaker:b")
FUNDING = fields("sym:s fundingTime:ts fundingRate:f markPrice:f")
BARS = fields("sym:s bn:j barstart:ts barend:ts open:f high:f low:f close:f qty:f dqty:f ticks:j buys:j bqty:f sqty:f vwap:f theta:f et:f pb:f ed:f th:f warmup:b")
LABELS = fields("sym:s bn:j close:f sigma:f endBn:j upperPx:f lowerPx:f label:j retAtTouch:f reason:s")
