"""The dimension of games and the families of sports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names of games and their ids. Two names share one id.
GAMES = {
    "unknown": "unknown",
    "csgo": "5f757d4d53f55124cedc8baf",
    "val": "5f51f4c31493307c241eee01",
    "lol": "60e3f4afe771f332c8f0b299",
    "r6": "613af39b140a39181c6468db",
    "fortnite": "65bb360d0e406c26d3ecc998",
    "dota": "60ec12b93b3e8f12cf4369e0",
    "football": "6622504e845d0e572cddc306",
    "cricket": "68b7fd9f414719f5a368fae0",
    "tennis": "66d6c02a3bcddbe90596e219",
    "kabaddi": "66d6e8393bcddbe90596e21b",
    "f1": "670d2535cf4de84701607781",
    "UFC": "6718b6b3a1ad42510b0930b9",
    "TT": "6748331f70fd55361942a736",
    "basketball": "64f005373ea28abf77106ca3",
    "golf": "67fc6e626d0b02e4b174287b",
    "american-football": "681d9c80039aed2d32f6334c",
    "field-hockey": "68248cf49d3393de142e16a8",
    "ice-hockey": "685297f49e24feb988a1ad4e",
    "downhillSkating": "6847f7dad4c69890176bb27c",
    "baseball": "68593898ad966fbef19b59ad",
    "taekwondo": "685bbd64ad966fbef19b5a09",
    "handball": "6865556ea425fc77ac37b887",
    "volleyball": "68695c52a425fc77ac37b8da",
    "rugby": "686f466040b6ff00535658f6",
    "boxing": "686f9f9840b6ff0053565929",
    "motogp": "6875e08440b6ff0053565966",
    "badminton": "68774ad4fb3597dc20397615",
    "wrestling": "688c1c3b45e318c6b03ad435",
    "mma": "689104c360df09a49d097f4f",
    "air-race": "68a54ff32de1b006dc1b9fea",
    "net-ball": "68adb24385e15fb47c349b7f",
    "cricket-2": "68b7fd9f414719f5a368fae0",
    "athletics": "69049b1ddf22c84448a7b9e2",
    "weightlifting": "69049918df22c84448a7b9de",
    "para_powerlifting": "6904990ddf22c84448a7b9dc",
    "camel_racing": "6904988fdf22c84448a7b9da",
    "equestrian": "69049880df22c84448a7b9d8",
    "swimming": "69049865df22c84448a7b9d6",
    "duathlon": "6904977ddf22c84448a7b9d4",
    "wushu": "6904973cdf22c84448a7b9d2",
    "kurash": "6904972ddf22c84448a7b9d0",
    "pencak_silat": "690496d4df22c84448a7b9ce",
    "wrestling_olympics": "690496bedf22c84448a7b9cc",
    "taekwondo_olympics": "690496a9df22c84448a7b9ca",
    "muay_thai": "6904960cdf22c84448a7b9c8",
    "karate": "690495fcdf22c84448a7b9c6",
    "ju_jitsu": "69049597df22c84448a7b9c4",
    "judo": "6904957edf22c84448a7b9c2",
    "fencing": "690494dadf22c84448a7b9c0",
    "boxing_olympics": "6904946bdf22c84448a7b9be",
    "tekken_8": "6904936fdf22c84448a7b9bc",
    "rocket_league": "69049307df22c84448a7b9ba",
    "volleyball_olympics": "690492abdf22c84448a7b9b8",
    "table_tennis_olympics": "69049223df22c84448a7b9b6",
    "handball_olympic": "690491c8df22c84448a7b9b4",
    "futsal": "6904900bdf22c84448a7b9b2",
    "basketball_olympic": "69048ec2df22c84448a7b9af",
}
#: Families of sports.
FAMILIES = {
    "combat": ["wushu", "kurash", "pencak_silat", "wrestling_olympics", "taekwondo_olympics", "muay_thai", "karate", "ju_jitsu", "judo", "boxing_olympics"],
    "athletic": ["athletics", "equestrian", "weightlifting", "para_powerlifting", "duathlon", "fencing"],
    "racket": ["table_tennis_olympics"],
}


def games(spark: SparkSession) -> DataFrame:
    """game string, game_id string: a dimension of a fixed size, small enough to broadcast."""
    return spark.createDataFrame(list(GAMES.items()), "game string, game_id string")


def with_game_id(rows: DataFrame, game: str = "game") -> DataFrame:
    """rows with the id of their game; null for a name that the dimension lacks. rows must not have a column game_id."""
    known = games(rows.sparkSession).withColumnRenamed("game", "_game")
    return rows.join(F.broadcast(known), F.col(game) == F.col("_game"), "left").drop("_game")


def family(game: Column) -> Column:
    """The family a sport belongs to; null without one."""
    out = F.lit(None).cast("string")
    for name, members in FAMILIES.items():
        out = F.when(game.isin(members), name).otherwise(out)
    return out
