"""The account risk score as a stream: signals are retracted when their look-back
ends, by event-time timers.

Facts come in as rows (account, customer, kind, ts, at): ``ts`` is the time that a
look-back counts from (a window's end, a transaction's time), ``at`` the event
time by which the stream advances.  ``NOW()`` is the newest ``at`` of the batches
before.  Two stateful steps:

1. ``Accounts``, keyed by customer: the accounts that a customer has ever used, and
   the newest time of the customer's own signals; gives these to each account.
2. ``Scores``, keyed by account: newest time of every signal and customer, and
   what was last given out.  A timer stands at the next instant at which
   something ends.  A micro-batch does work for accounts with new facts or a due
   timer and gives out only rows that changed; nothing else is read.

The score itself is the batch expression over the signals of a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from riskstream.constants import ACTIVE_ACCOUNT_LOOKBACK, SIGNAL_WEIGHTS
from riskstream.functions.time import interval_micros
from riskstream.operators import risk

#: Event times may lag the newest by so much; older facts have ended anyway.
DELAY = "3 hours"
SEEN, BRUTE, COMPOUND = "seen", "brute_force", "compound_fraud"
FACT = "account_id string, customer_id string, kind string, ts timestamp, at timestamp"
COLUMNS = ["account_id", "customer_id", "kind", "ts", "at"]
CHANGE = "account_id string, customer_id string, kinds string, alive boolean, now_ms long"


def micros(times: pd.Series) -> pd.Series:
    return times.astype("datetime64[us]").astype("int64")


def some(v):
    """A key's part; missing strings come as None or NaN."""
    return v if isinstance(v, str) else None


class Accounts(StatefulProcessor):
    def init(self, handle) -> None:
        self.accounts = handle.getMapState("accounts", "account string", "first_us long")
        self.newest = handle.getMapState("newest", "kind string", "us long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        customer, at = some(key[0]), None
        seen, kinds = {}, {}
        for pdf in rows:
            at = pdf["at"].max() if at is None else max(at, pdf["at"].max())
            best = pdf.assign(us=micros(pdf["ts"]), account_id=pdf["account_id"].map(some))
            for (account, kind), us in best.groupby(["account_id", "kind"], dropna=False)["us"].max().items():
                into, name = (seen, some(account)) if kind == SEEN else (kinds, kind)
                into[name] = max(into.get(name, us), us)
        new = [a for a in seen if a is not None and not self.accounts.containsKey((a,))]
        for account in new:
            self.accounts.updateValue((account,), (int(seen[account]),))
        risen = {}
        for kind, us in kinds.items():
            if not self.newest.containsKey((kind,)) or self.newest.getValue((kind,))[0] < us:
                self.newest.updateValue((kind,), (int(us),))
                risen[kind] = us
        out = [(account, customer, SEEN, us) for account, us in seen.items()]
        if risen and customer is not None:
            out += [(a[0], customer, k, us) for a in self.accounts.keys() for k, us in risen.items()]
        if new and customer is not None:
            out += [(a, customer, k[0], us[0]) for k, us in self.newest.iterator()
                    if k[0] not in risen for a in new]
        if out:
            df = pd.DataFrame(out, columns=COLUMNS[:4])
            yield df.assign(ts=pd.to_datetime(df["ts"], unit="us"), at=at)

    def close(self) -> None:
        pass


class Scores(StatefulProcessor):
    """``lookback``: microseconds by kind; ``active``: of an account's activity."""

    def __init__(self, lookback: dict[str, int], active: int, delay: int):
        self.lookback, self.active, self.delay = lookback, active, delay

    def init(self, handle) -> None:
        self.handle = handle
        self.flags = handle.getMapState("flags", "kind string", "us long")
        self.brute = handle.getMapState("brute", "customer string", "us long")
        self.seen = handle.getMapState("seen", "customer string", "us long")
        self.given = handle.getMapState("given", "customer string", "kinds string")
        self.timer = handle.getValueState("timer", "ms long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        newest = {}
        for pdf in rows:
            best = pdf.assign(us=micros(pdf["ts"]), customer_id=pdf["customer_id"].map(some))
            for (customer, kind), us in best.groupby(["customer_id", "kind"],
                                                     dropna=False)["us"].max().items():
                newest[customer, kind] = max(newest.get((customer, kind), us), us)
        for (customer, kind), us in newest.items():
            who = some(customer) or ""
            if kind in (SEEN, BRUTE):
                state, name = (self.seen if kind == SEEN else self.brute), (who,)
            else:
                state, name = self.flags, (kind,)
            if not state.containsKey(name) or state.getValue(name)[0] < us:
                state.updateValue(name, (int(us),))
        yield from self._changes(some(key[0]), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        self.timer.clear()
        yield from self._changes(some(key[0]), timerValues)

    def _alive(self, state, lookback, now: int) -> dict[str, int]:
        """Entries that have not ended with the instant each ends; others go."""
        out = {}
        for (name,), (us,) in list(state.iterator()):
            end = us + (lookback[name] if isinstance(lookback, dict) else lookback)
            if end < now:
                state.removeKey((name,))
            else:
                out[name] = end
        return out

    def _changes(self, account, timer_values) -> Iterator[pd.DataFrame]:
        now_ms = timer_values.getCurrentWatermarkInMs() + self.delay // 1000
        now = now_ms * 1000
        flags = self._alive(self.flags, self.lookback, now)
        brute = self._alive(self.brute, self.lookback[BRUTE], now)
        seen = self._alive(self.seen, self.active, now)
        was = {c: kinds for (c,), (kinds,) in list(self.given.iterator())}
        out = []
        for customer in seen:
            names = [*flags, *[BRUTE] * (customer in brute)] if account is not None else []
            kinds = ",".join(sorted(names))
            if was.get(customer) != kinds:
                self.given.updateValue((customer,), (kinds,))
                out.append((account, customer or None, kinds, True, now_ms))
        for customer in was.keys() - seen.keys():
            self.given.removeKey((customer,))
            out.append((account, customer or None, was[customer], False, now_ms))
        ends = [*flags.values(), *brute.values(), *seen.values()]
        due = (min(ends) // 1000 + 1 - self.delay // 1000) if ends else None
        old = self.timer.get()[0] if self.timer.exists() else None
        if due != old:
            if old is not None:
                self.handle.deleteTimer(old)
            if due is None:
                self.timer.clear()
            else:
                self.handle.registerTimer(due)
                self.timer.update((due,))
        if out:
            yield pd.DataFrame(out, columns=["account_id", "customer_id", "kinds", "alive", "now_ms"])

    def close(self) -> None:
        pass


def facts(df: DataFrame, kind: str, ts: str, at: str, account: str | None = "account_id",
          customer: str | None = "customer_id", flag: str | None = None) -> DataFrame:
    """Rows of a signal (or of transactions, ``SEEN``) as facts."""
    if flag is not None:
        df = df.where(F.col(flag))
    name = lambda c: (F.col(c) if c else F.lit(None).cast("string"))
    return df.select(name(account).alias("account_id"), name(customer).alias("customer_id"),
                     F.lit(kind).alias("kind"), F.col(ts).alias("ts"), F.col(at).alias("at")) \
        .where(F.col("ts").isNotNull() & F.col("at").isNotNull())


#: How each signal's rows become facts: (kind, ts, at, account, customer, flag).
SIGNALS = {
    "velocity_alerts": ("velocity", "window_end", "window_start", "account_id", None,
                        "is_velocity_breach"),
    "cnp_spike": ("cnp_spike", "window_end", "window_start", "account_id", None, "is_cnp_spike"),
    "structuring": ("structuring", "window_end", "window_start", "account_id", None,
                    "is_structuring_pattern"),
    "geo_hops": ("geo_impossible", "txn2_time", "txn2_time", "txn2_account_id", None,
                 "is_impossible"),
    "device_anomalies": ("device_anomaly", "occurred_at", "occurred_at", "account_id", None,
                         "combined_risk_flag"),
    "login_failure_storm": (BRUTE, "window_end", "window_start", None, "customer_id",
                            "is_brute_force"),
    "correlated_alert_burst": (COMPOUND, "window_end", "window_start", None, "customer_id",
                               "is_compound_fraud"),
}


def signal_facts(name: str, df: DataFrame) -> DataFrame:
    kind, ts, at, account, customer, flag = SIGNALS[name]
    return facts(df, kind, ts, at, account, customer, flag)


def score_changes(stream: DataFrame, lookback: dict[str, str] | None = None,
                  active: str = ACTIVE_ACCOUNT_LOOKBACK, delay: str = DELAY) -> DataFrame:
    """Changed rows of the score from a stream of facts (all kinds in one stream):
    account_id, customer_id, risk_score, contributing_signals, risk_tier, alive,
    now_ms.  Kept by (account, customer), the rows with ``alive`` are the score.
    """
    limits = {k: interval_micros(v) for k, v in {**risk.LOOKBACK, **(lookback or {})}.items()}
    marked = stream.withWatermark("at", delay)
    of_customers = F.col("kind").isin(SEEN, BRUTE, COMPOUND)
    spread = marked.where(of_customers).groupBy("customer_id").transformWithStateInPandas(
        Accounts(), FACT, "append", "EventTime", eventTimeColumnName="at")
    each = spread.unionByName(marked.where(~of_customers)).groupBy("account_id")
    changed = each.transformWithStateInPandas(
        Scores(limits, interval_micros(active), interval_micros(delay)), CHANGE, "append",
        "EventTime")
    held: dict[str, Column] = {
        name: F.array_contains(F.split("kinds", ","), name).cast("int") for name, _ in SIGNAL_WEIGHTS}
    score, names = risk.score_columns(held)
    return changed.select("account_id", "customer_id", score.alias("risk_score"),
                          names.alias("contributing_signals"), risk.risk_tier(score).alias("risk_tier"),
                          "alive", "now_ms")


def score_view(table: DataFrame) -> DataFrame:
    """The score among the kept changes."""
    return table.where("alive").drop("alive", "now_ms")
