"""Raw play-by-play events to possession statistics.

A possession is held by one team and ends with a made shot (unless a bonus free throw follows at the same clock), the made
last free throw of a trip, a defensive rebound, a turnover, a jump ball that the other team wins, or the end of the period.
Free throws for technical fouls score without touching the possession, those for flagrant and clear-path fouls leave the ball
with the shooters. It belongs to the lineups on court at its last attempt or turnover, and free throws, with the
possession that they end, to the lineups at the foul, whoever comes in before they are shot. Points of the team that
doesn't hold the ball are its own for the same matchup.

Period starters of a team are those who act on court or leave before they enter, and, where fewer than five do, players of its
other periods who are not seen to enter later. A period that ends up with another number than five fails its game further on.
The logic needs the order of events, so it runs per game on at most a few hundred rows; workers read sorted games one after the
other as plain tuples and return one row per credit of a team, not one per player.
"""

from __future__ import annotations

import re
from collections import namedtuple
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby, islice
from operator import attrgetter

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from courtside.functions.columns import player_ids
from courtside.schema import LINEUP_SIZE, STAT_ROWS
from courtside.sources.payloads import result_rows

# Event kinds, kinds without effect (violation, timeout, ejection, replay, stoppage), the types of persons that
# are players, foul types that may be called on the bench (technicals and the like), and the smallest team id.
MADE, MISSED, FREE_THROW, REBOUND, TURNOVER, FOUL, SUBSTITUTION, JUMP_BALL, START, END = 1, 2, 3, 4, 5, 6, 8, 10, 12, 13
NEUTRAL = (7, 9, 11, 18, 20)
HANDLED = (MADE, MISSED, FREE_THROW, REBOUND, TURNOVER, FOUL, SUBSTITUTION, JUMP_BALL, START, END, *NEUTRAL)
PLAYER_KINDS = (4, 5)
BENCH_FOULS = (11, 12, 13, 16, 17, 18, 19, 25, 30)
OFF_COURT = frozenset((*NEUTRAL, START, END))
KNOWN = frozenset(HANDLED)
TEAM_IDS = 1_600_000_000
HEADERS = {"GAME_ID": "string", "EVENTNUM": "long", "EVENTMSGTYPE": "int", "EVENTMSGACTIONTYPE": "int", "PERIOD": "int", "PCTIMESTRING": "string"}
HEADERS |= {"HOMEDESCRIPTION": "string", "NEUTRALDESCRIPTION": "string", "VISITORDESCRIPTION": "string", "SCORE": "string"}
HEADERS |= {f"PLAYER{n}_{x}": "long" for n in (1, 2, 3) for x in ("ID", "TEAM_ID")} | {f"PERSON{n}TYPE": "int" for n in (1, 2, 3)}
_TRIP = re.compile(r"(\d) of (\d)")
#: Begins the lineups of a game that can't be read.
UNREADABLE = "unreadable: "
#: One row per possession and statistic, for all players of the credited team: STAT_ROWS without the player.
CREDITS = T.StructType([f for f in STAT_ROWS if f.name != "player_id"])


def read_events(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return result_rows(spark, paths, HEADERS)


def event_points() -> Column:
    """The points that an event scores."""
    text = F.concat_ws(" ", "HOMEDESCRIPTION", "NEUTRALDESCRIPTION", "VISITORDESCRIPTION")
    shot = F.when(text.contains("3PT"), 3).otherwise(2)
    return F.when(F.col("EVENTMSGTYPE") == MADE, shot).when((F.col("EVENTMSGTYPE") == FREE_THROW) & ~text.contains("MISS"), 1).otherwise(0)


def final_scores(events: DataFrame) -> DataFrame:
    """(game_id, event_order, score): the running scores of the feed, or of a game without any the sum of its shots."""
    parts = F.split(F.regexp_replace("SCORE", " ", ""), "-")
    shown = F.when(F.col("SCORE").rlike(r"^\s*\d+\s*-\s*\d+\s*$"), F.create_map(F.lit("away"), F.get(parts, 0).cast("long"), F.lit("home"), F.get(parts, 1).cast("long")))
    rows = events.select(F.col("GAME_ID").alias("game_id"), F.col("EVENTNUM").alias("event_order"), shown.alias("score"), event_points().cast("long").alias("points"))
    last = rows.groupBy("game_id").agg(F.max_by("score", F.when(F.col("score").isNotNull(), F.col("event_order"))).alias("score"), F.max("event_order").alias("event_order"), F.sum("points").alias("points"))
    return last.select("game_id", "event_order", F.coalesce("score", F.create_map(F.lit("both"), F.col("points"))).alias("score"))


#: What the state machine reads of an event; null is None. text: the descriptions that are there, in one.
FIELDS = {"GAME_ID": "string", "EVENTNUM": "long", "EVENTMSGTYPE": "int", "EVENTMSGACTIONTYPE": "int", "PERIOD": "int", "PCTIMESTRING": "string", "TEXT": "string"}
FIELDS |= {f"PLAYER{n}_{x}": "long" for n in (1, 2, 3) for x in ("ID", "TEAM_ID")} | {f"PERSON{n}TYPE": "int" for n in (1, 2, 3)}
DESCRIPTIONS = ("HOMEDESCRIPTION", "NEUTRALDESCRIPTION", "VISITORDESCRIPTION")
Event = namedtuple("Event", FIELDS)


def _people(e: Event) -> list[tuple[int, int]]:
    """(team, player) of the players that an event names."""
    named = ((e.PLAYER1_ID, e.PLAYER1_TEAM_ID, e.PERSON1TYPE), (e.PLAYER2_ID, e.PLAYER2_TEAM_ID, e.PERSON2TYPE), (e.PLAYER3_ID, e.PLAYER3_TEAM_ID, e.PERSON3TYPE))
    return [(team, player) for player, team, kind in named if player is not None and team is not None and 0 < player < TEAM_IDS and (kind is None or kind in PLAYER_KINDS)]


def _team(e: Event) -> int | None:
    """The team of an event: that of its first player, or the team it names in a player's place."""
    if e.PLAYER1_TEAM_ID is not None:
        return e.PLAYER1_TEAM_ID
    return e.PLAYER1_ID if e.PLAYER1_ID is not None and e.PLAYER1_ID >= TEAM_IDS else None


def _starters(events: list[Event], others: dict[int, list[int]]) -> dict[int, list[int]]:
    """The five of each team at the start of a period."""
    first: dict[int, dict[int, str]] = {}
    for e in events:
        kind = e.EVENTMSGTYPE
        if kind in OFF_COURT or (kind == FOUL and e.EVENTMSGACTIONTYPE in BENCH_FOULS):
            continue
        for k, (team, player) in enumerate(_people(e)):
            first.setdefault(team, {}).setdefault(player, "enters" if kind == SUBSTITUTION and k == 1 else "on")
    out = {}
    for team in {*first, *others}:
        seen = first.get(team, {})
        five = [p for p, what in seen.items() if what == "on"]
        five += [p for p in others.get(team, []) if p not in seen and p not in five][: LINEUP_SIZE - len(five)]
        out[team] = five
    return out


@dataclass
class Game:
    """The state of a game while its events are read, and the credits (CREDITS) so far."""

    game_id: str
    rows: list[tuple] = field(default_factory=list)
    score: dict[int, int] = field(default_factory=dict)
    court: dict[int, list[int]] = field(default_factory=dict)
    at: int = 0
    period: int = 0
    clock: str = ""
    holder: int | None = None
    #: The lineups that the possession belongs to, once it has had an attempt, and those at the last foul.
    attempt: dict[int, list[int]] | None = None
    fouled: dict[int, list[int]] | None = None
    #: Score of both teams when the possession began.
    began: dict[int, int] = field(default_factory=dict)

    def other(self, team: int) -> int:
        return next(t for t in sorted(self.court) if t != team)

    def snapshot(self) -> dict[int, list[int]]:
        return {t: sorted(five) for t, five in self.court.items()}

    def _row(self, team: int, court: dict[int, list[int]], key: str, value: int) -> None:
        """A credit of the team's players, if it has any."""
        opponent = self.other(team)
        lead = self.began.get(team, 0) - self.began.get(opponent, 0)
        if own := court[team]:
            self.rows.append((self.game_id, self.at, self.period, self.clock, lead, team, opponent, "-".join(map(str, own)), "-".join(map(str, court[opponent])), key, value))

    def points(self, team: int, n: int, court: dict[int, list[int]]) -> None:
        self._row(self.other(team), court, "OpponentPoints", n)
        self.score[team] = self.score.get(team, 0) + n

    def has(self, team: int) -> None:
        """The team acts with the ball: a possession of the other one that no event ended is over."""
        if self.holder is not None and self.holder != team:
            self.end(self.clock)
        self.holder = team

    def end(self, clock: str, to: int | None = None) -> None:
        """The possession ends, and the ball goes to the other team or to the one named."""
        holder = self.holder
        if holder is not None:
            self._row(holder, self.attempt or self.snapshot(), "OffPoss", 1)
        self.at += 1
        self.clock, self.began, self.attempt = clock, dict(self.score), None
        self.holder = to if to is not None else self.other(holder) if holder is not None else None


def _bonus(later: Iterable[Event], shot: Event) -> bool:
    """Whether a free throw of one follows a made shot at the same clock."""
    for e in later:
        if e.PCTIMESTRING != shot.PCTIMESTRING or e.EVENTMSGTYPE in (MADE, MISSED, END):
            return False
        if e.EVENTMSGTYPE == FREE_THROW and _team(e) == _team(shot) and "1 of 1" in e.TEXT and "Flagrant" not in e.TEXT:
            return True
    return False


def _free_throw(game: Game, e, pending: list) -> None:
    """pending[0] becomes the team whose missed last free throw is to be rebounded."""
    team, text = _team(e), e.TEXT
    made, court = "MISS" not in text, game.fouled or game.snapshot()
    if "Technical" in text:
        if made:
            game.points(team, 1, game.snapshot())
        return
    trip = _TRIP.search(text)
    last = trip is None or trip[1] == trip[2]
    game.has(team)
    game.attempt = court
    if made:
        game.points(team, 1, court)
    if last and "Flagrant" not in text and "Clear Path" not in text:
        if made:
            game.end(e.PCTIMESTRING)
        else:
            pending[:] = [team]
    elif not made:
        pending[:] = [None]  # the rebound that the feed shows next is none


def credits_of(table: list[Event]) -> list[tuple]:
    """The credits (CREDITS) of one game, from its events in order."""
    game = Game(table[0].GAME_ID)
    known = _starters(table, {})  # who is seen on court first in the game
    last: dict[int, list[int]] = {}
    periods: dict[int, list[Event]] = {}
    for e in table:
        if e.PERIOD is not None:
            periods.setdefault(e.PERIOD, []).append(e)
    for period, rows in sorted(periods.items()):
        game.court, game.period, game.clock = _starters(rows, last or known), period, rows[0].PCTIMESTRING
        game.holder = game.attempt = game.fouled = None
        game.began = dict(game.score)
        pending: list = []
        for k, e in enumerate(rows):
            kind, team = e.EVENTMSGTYPE, _team(e)
            if kind == JUMP_BALL:
                winner = e.PLAYER3_TEAM_ID if e.PLAYER3_TEAM_ID is not None else e.PLAYER3_ID
                if winner is not None and winner in game.court:
                    game.has(winner)
            elif kind == SUBSTITUTION:
                out, into = int(e.PLAYER1_ID), int(e.PLAYER2_ID)
                game.court[team] = [into if p == out else p for p in game.court[team]]
            elif kind == FOUL:
                game.fouled = game.snapshot()
            elif kind == MADE:
                game.has(team)
                game.attempt = game.snapshot()
                game.points(team, 3 if "3PT" in e.TEXT else 2, game.attempt)
                if not _bonus(islice(rows, k + 1, None), e):
                    game.end(e.PCTIMESTRING)
            elif kind == MISSED:
                game.has(team)
                game.attempt = game.snapshot()
                pending[:] = [team]
            elif kind == FREE_THROW:
                _free_throw(game, e, pending)
            elif kind == REBOUND and pending:
                shooter = pending.pop()
                if shooter is not None and team is not None and team != shooter:
                    game.end(e.PCTIMESTRING, to=team)
            elif kind == TURNOVER and team in game.court and e.EVENTMSGACTIONTYPE != 0:
                game.has(team)
                game.attempt = game.attempt or game.snapshot()
                game.end(e.PCTIMESTRING)
            elif kind == END and game.holder is not None:
                game.end(e.PCTIMESTRING)
                game.holder = None
        last = {t: list(f) for t, f in game.court.items()}
    return game.rows


def credits_or_error(table: list[Event]) -> list[tuple]:
    """credits_of(), or where a game can't be read one credit that makes it fail with the reason."""
    try:
        return credits_of(table)
    except Exception as error:
        reason = f"{UNREADABLE}{type(error).__name__}: {error}"
        return [(table[0].GAME_ID, 0, 1, "12:00", 0, 0, 0, reason, reason, "OffPoss", 1)]


def _events_of(table: pd.DataFrame) -> list[Event]:
    """The events of a pandas table, in order."""
    table = table.sort_values("EVENTNUM", kind="stable")
    rows = table.to_dict("records")
    whole = lambda x: None if x is None or pd.isna(x) else int(x)
    string = lambda x: None if x is None or pd.isna(x) else str(x)
    text = lambda r: " ".join(str(r[c]) for c in DESCRIPTIONS if pd.notna(r.get(c)) and r.get(c))
    return [Event(*[text(r) if c == "TEXT" else (string if kind == "string" else whole)(r.get(c)) for c, kind in FIELDS.items()]) for r in rows]


def _per_player(credits: list[tuple]) -> pd.DataFrame:
    rows = [(*c[:5], int(p), *c[5:]) for c in credits for p in (["0"] if c[7].startswith(UNREADABLE) else c[7].split("-"))]
    return pd.DataFrame(rows, columns=STAT_ROWS.fieldNames())


def game_statistics(table: pd.DataFrame) -> pd.DataFrame:
    """The statistics rows (STAT_ROWS) of one game."""
    return _per_player(credits_of(_events_of(table)))


def statistics_or_error(table: pd.DataFrame) -> pd.DataFrame:
    """game_statistics(), or where a game can't be read one row that makes it fail with the reason."""
    return _per_player(credits_or_error(_events_of(table)))


def unsupported_games(events: DataFrame) -> DataFrame:
    """(game_id, error) of games with event kinds that are not known."""
    odd = events.where(F.col("EVENTMSGTYPE").isNull() | ~F.col("EVENTMSGTYPE").isin(*HANDLED))
    return odd.groupBy(F.col("GAME_ID").alias("game_id")).agg(F.concat(F.lit("ValueError: unsupported event types "), F.array_join(F.array_sort(F.collect_set(F.col("EVENTMSGTYPE").cast("string"))), ",")).alias("error"))


def _column(values: pa.Array) -> list:
    """The values of a column; null is None."""
    if values.null_count == len(values):
        return [None] * len(values)
    if pa.types.is_string(values.type):
        coded = values.dictionary_encode()
        names = [*coded.dictionary.to_pylist(), None]
        return [names[k] for k in coded.indices.fill_null(len(names) - 1).to_numpy().tolist()]
    out = values.fill_null(0).to_numpy(zero_copy_only=False).tolist()
    for k in values.is_null().to_numpy(zero_copy_only=False).nonzero()[0].tolist() if values.null_count else ():
        out[k] = None
    return out


def _games(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[bool, list[Event]]]:
    """The events of each game, which follow each other, and whether it is the last one that a batch ends."""
    held: list[Event] = []
    for batch in batches:
        for _, rows in groupby(map(Event._make, zip(*map(_column, batch.columns), strict=True)), key=attrgetter("GAME_ID")):
            rows = list(rows)
            if held and held[0].GAME_ID != rows[0].GAME_ID:
                yield False, held
                held = []
            held += rows
        yield True, []
    if held:
        yield True, held


def _credited(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = to_arrow_schema(CREDITS)
    rows: list[tuple] = []
    for flush, game in _games(batches):
        if game and all(e.EVENTMSGTYPE in KNOWN for e in game):
            rows += credits_or_error(game)
        if flush and rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
            rows = []


def possession_credits(events: DataFrame) -> DataFrame:
    """CREDITS of all games whose events are known: games are brought together, sorted, and read one after the other."""
    there = [F.when(F.col(c) != "", F.col(c)) for c in DESCRIPTIONS if c in events.columns]
    own = lambda c, kind: F.concat_ws(" ", *there) if c == "TEXT" else F.col(c) if c in events.columns else F.lit(None)
    slim = events.select(*[own(c, kind).cast(kind).alias(c) for c, kind in FIELDS.items()])
    return slim.repartition("GAME_ID").sortWithinPartitions("GAME_ID", F.col("EVENTNUM").asc_nulls_last()).mapInArrow(_credited, CREDITS)


def _players() -> Column:
    """The players that a credit is for; 0 stands for those of an unreadable game."""
    return F.when(F.startswith(F.col("lineup_id"), F.lit(UNREADABLE)), F.array(F.lit(0).cast("long"))).otherwise(player_ids(F.col("lineup_id")))


def possession_statistics(events: DataFrame) -> DataFrame:
    """STAT_ROWS of all games whose events are known."""
    return possession_credits(events).withColumn("player_id", F.explode(_players())).select(*STAT_ROWS.fieldNames())


def possession_totals(events: DataFrame) -> DataFrame:
    """possession_statistics() with one row for all players of a credit, which has the sum of theirs."""
    return possession_credits(events).withColumn("stat_value", F.col("stat_value") * F.size(_players()))
