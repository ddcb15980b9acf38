"""Lookup tables.

Fixed values that results depend on.  Larger tables (the raw-position map, slots
and coordinates per formation, the full qualifier list, the metric lists per
position) are loaded
with :func:`scoutlake.sources.tables.lookup` from a path the caller gives.
"""

# Event type id and name.
EVENT_TYPES = {
    1: 'Pass', 2: 'Offside Pass', 3: 'Take On', 4: 'Foul', 5: 'Out', 6: 'Corner Awarded',
    7: 'Tackle', 8: 'Interception', 9: 'Turnover', 10: 'Save', 11: 'Claim', 12: 'Clearance',
    13: 'Miss', 14: 'Post', 15: 'Saved Shot', 16: 'Goal', 17: 'Card', 18: 'Player Off',
    19: 'Player on', 20: 'Player retired', 21: 'Player returns', 22: 'Player becomes goalkeeper',
    23: 'Goalkeeper becomes player', 24: 'Condition change', 25: 'Official change',
    27: 'Start delay', 28: 'End delay', 30: 'End', 32: 'Start', 34: 'Team setp up',
    35: 'Player changed position', 36: 'Player changed Jersey number', 37: 'Collection End',
    38: 'Temp_Goal', 39: 'Temp_Attempt', 40: 'Formation change', 41: 'Punch', 42: 'Good skill',
    43: 'Deleted event', 44: 'Aerial', 45: 'Challenge', 47: 'Rescinded card', 49: 'Ball recovery',
    50: 'Dispossessed', 51: 'Error', 52: 'Keeper pick-up', 53: 'Cross not claimed', 54: 'Smother',
    55: 'Offside provoked', 56: 'Shield ball opp', 57: 'Foul throw-in', 58: 'Penalty faced ',
    59: 'Keeper Sweeper', 60: 'Chance missed', 61: 'Ball touch', 63: 'Temp_Save', 64: 'Resume',
    65: 'Contentious referee decision', 66: 'Possession Data', 67: '50/50',
    68: 'Referee Drop Ball', 69: 'Failed to Block', 70: 'Injury Time Announcement',
    71: 'Coach Setup', 72: 'Caught Offside', 73: 'Other Ball Contact', 74: 'Blocked Pass',
    75: 'Delayed Start', 76: 'Early end', 77: 'Player Off Pitch',
}

# Event types that are not playing actions.
NON_PLAYING_TYPES = [
    'Start delay', 'End delay', 'End', 'Start', 'Team setp up', 'Player changed position',
    'Player changed Jersey number', 'Collection End', 'Temp_Goal', 'Temp_Attempt',
    'Formation change', 'Deleted event', 'Rescinded card', 'Condition change', 'Official change',
    'Player Off', 'Player on', 'Player retired', 'Player returns', 'Player becomes goalkeeper',
    'Goalkeeper becomes player', 'Contentious referee decision', 'Possession Data',
    'Referee Drop Ball', 'Injury Time Announcement', 'Coach Setup', 'Delayed Start', 'Early end',
    'Player Off Pitch', 'Resume',
]

# Qualifiers read by the pass and shot maps.
QUALIFIERS = {
    56: "Zone", 102: "Goal Mouth Y Coordinate", 103: "Goal Mouth Z Coordinate",
    140: "Pass End X", 141: "Pass End Y",
    146: "Blocked X Coordinate", 147: "Blocked Y Coordinate", 212: "Length", 213: "Angle",
}

# Raw position name of either provider and its canonical name.
POSITIONS = {
    '0': 'Unknown', 'AM': 'Attacking Midfielder', 'Attacker': 'Attacker',
    'Attacking Midfielder Centre': 'Attacking Midfielder Centre',
    'Attacking Midfielder Centre/Right': 'Attacking Midfielder Centre/Right',
    'Attacking Midfielder Left': 'Attacking Midfielder Left',
    'Attacking Midfielder Left/Centre': 'Attacking Midfielder Left/Centre',
    'Attacking Midfielder Right': 'Attacking Midfielder Right', 'D': 'Defender',
    'DC': 'Center-Back', 'DL': 'Left Full-Back', 'DM': 'Defensive Midfielder',
    'DR': 'Right Full-Back', 'Defender': 'Defender', 'Defender Centre': 'Defender Centre',
    'Defender Centre/Right': 'Defender Centre/Right', 'Defender Left': 'Defender Left',
    'Defender Left/Centre': 'Defender Left/Centre', 'Defender Right': 'Defender Right',
    'Defensive Midfielder Centre': 'Defensive Midfielder Centre',
    'Defensive Midfielder Centre/Right': 'Defensive Midfielder Centre/Right',
    'Defensive Midfielder Left': 'Defensive Midfielder Left',
    'Defensive Midfielder Left/Centre': 'Defensive Midfielder Left/Centre',
    'Defensive Midfielder Right': 'Defensive Midfielder Right', 'F': 'Attacker', 'G': 'Goalkeeper',
    'GK': 'Goalkeeper', 'Goalkeeper': 'Goalkeeper', 'Goalkeeper Centre': 'Goalkeeper',
    'LW': 'Left Winger', 'M': 'Midfielder', 'MC': 'Central Midfielder',
    'ML': 'Left Wing-Midfielder', 'MR': 'Right Wing-Midfielder', 'Midfielder': 'Midfielder',
    'Midfielder Centre': 'Midfielder Centre', 'Midfielder Centre/Right': 'Midfielder Centre/Right',
    'Midfielder Left': 'Midfielder Left', 'Midfielder Left/Centre': 'Midfielder Left/Centre',
    'Midfielder Right': 'Midfielder Right', 'RW': 'Right Winger', 'ST': 'Striker',
    'Striker Centre': 'Striker Centre', 'Striker Centre/Right': 'Striker Centre/Right',
    'Striker Left': 'Striker Left', 'Striker Left/Centre': 'Striker Left/Centre',
    'Striker Right': 'Striker Right', 'Unknown': 'Unknown', 'Wing Back Left': 'Wing Back Left',
    'Wing Back Right': 'Wing Back Right', 'nan': 'Unknown',
}

# Canonical position name and short code for players without matches.
POSITION_CODES = {
    'Attacking Midfielder': 'AM', 'Center-Back': 'CB', 'Central Midfielder': 'DM',
    'Defensive Midfielder': 'DM', 'Goalkeeper': 'GK', 'Left Full-Back': 'LB',
    'Left Wing-Midfielder': 'LW', 'Left Winger': 'LW', 'Right Full-Back': 'RB',
    'Right Wing-Midfielder': 'RW', 'Right Winger': 'RW', 'Striker': 'ST', 'Attacker': 'ST',
    'Defender': 'CB', 'Midfielder': 'DM',
}

# Position code and the group without sides.
MAIN_POSITION = {"GK": "GK", "CB": "CB", "DM": "DM", "AM": "AM", "ST": "ST",
                 "LB": "FB", "RB": "FB", "LW": "WG", "RW": "WG"}
ROLE_POSITION = {"LB": "FB", "RB": "FB", "LW": "WG", "RW": "WG", "CM": "DM"}
GENERAL_POSITION = {"LW": "Attacker", "ST": "Attacker", "RW": "Attacker",
                    "LB": "Defender", "CB": "Defender", "RB": "Defender",
                    "DM": "Midfielder", "AM": "Midfielder"}

# Formation and the formation it is counted as.
FORMATIONS = {
    '4-2-3-1': '4-2-3-1', '4-3-1-2': '4-3-1-2', '3-4-2-1': '3-4-3', '4-3-3': '4-3-3',
    '3-5-2': '3-5-2', '5-3-2': '5-3-2', '3-4-1-2': '3-4-1-2', '4-4-2': '4-4-2', '4-2-4': '4-4-2',
    '4-2-2-2': '4-4-2', '4-2-1-3': '4-2-3-1', '4-1-3-2': '4-3-1-2', '4-3-2-1': '4-3-3',
    '3-4-3': '3-4-3', '4-1-4-1': '4-5-1', '3-1-4-2': '3-1-4-2', '4-4-1-1': '4-2-3-1',
    '3-2-4-1': '3-2-4-1', '4-5-1': '4-5-1', '3-5-1-1': '3-3-3-1', '5-4-1': '3-4-3',
    '3-3-1-3': '3-3-3-1', '3-3-3-1': '3-3-3-1',
}

# Country and mean club Elo of its league.
COUNTRY_ELO = {
    'England': 1775, 'Italy': 1718, 'Spain': 1689, 'Germany': 1666, 'France': 1660,
    'Portugal': 1541, 'Mexico': 1515, 'Belgium': 1505, 'Denmark': 1492, 'Netherlands': 1463,
    'Saudi Arabia': 1460, 'Russia': 1456, 'Austria': 1436, 'Türkiye': 1433, 'Norway': 1433,
    'Poland': 1410, 'Greece': 1402, 'Czechia': 1398, 'Sweden': 1385, 'Switzerland': 1380,
    'Scotland': 1344, 'Croatia': 1344, 'Ukraine': 1310, 'Serbia': 1280, 'Israel': 1275,
    'Cyprus': 1260, 'Romania': 1245, 'Bulgaria': 1230, 'Hungary': 1215, 'Azerbaijan': 1190,
    'Kazakhstan': 1180, 'Slovakia': 1175, 'Slovenia': 1160, 'Belarus': 1150, 'Finland': 1140,
    'Monaco': 1120, 'Ireland': 1110, 'Lithuania': 1090, 'Latvia': 1085, 'Albania': 1070,
    'Bosnia & Herzegovina': 1065, 'North Macedonia': 1050, 'Moldova': 1040, 'Georgia': 1030,
    'Luxembourg': 1020, 'Armenia': 1010, 'Northern Ireland': 1005, 'Montenegro': 1000,
    'Estonia': 990, 'Faroe Islands': 970, 'Kosovo': 960, 'Iceland': 950, 'Malta': 940,
    'Wales': 930, 'Gibraltar': 890, 'Andorra': 850, 'San Marino': 720,
}

# Competition and its weight.
COMPETITION_WEIGHT = {
    'la_liga': 40, 'premier_league': 40, 'bundesliga': 40, 'serie_a': 40, 'ligue_1': 40,
    'champions_league': 50, 'europa_league': 30, 'copa_del_rey': 30, 'la_liga_hypermotion': 20,
    'championship': 20, 'eredivise': 30, 'liga_portugal': 30, 'conference_league': 30,
    'copa_libertadores': 20, 'liga_mx': 20, 'serie_a_brazil': 20, 'liga_profesional': 20,
    'first_division_a': 20, 'major_league_soccer': 20, 'saudi_pro_league': 20, 'super_lig': 20,
    'superligaen': 20, 'swiss_super_league': 20, 'allvenskan': 20, 'eliteserien': 20,
    'conmebol_sudamericana': 20,
}
DEFAULT_WEIGHT = 20

# Competition and its tier, formation and its family.
COMPETITION_TIER = {
    'champions_league': 'A', 'premier_league': 'A', 'la_liga': 'A', 'bundesliga': 'A',
    'serie_a': 'A', 'ligue_1': 'A', 'europa_league': 'B', 'liga_portugal': 'B', 'eredivise': 'B',
    'super_lig': 'B', 'first_division_a': 'B', 'championship': 'B', 'conference_league': 'C',
    'copa_del_rey': 'C', 'la_liga_hypermotion': 'C', 'swiss_super_league': 'C', 'superligaen': 'C',
    'saudi_pro_league': 'C', 'copa_libertadores': 'D', 'conmebol_sudamericana': 'D',
    'serie_a_brazil': 'D', 'liga_profesional': 'D', 'liga_mx': 'D', 'major_league_soccer': 'D',
    'eliteserien': 'E', 'allvenskan': 'E',
}

FORMATION_FAMILY = {
    '4-2-3-1': 'A', '4-1-4-1': 'A', '4-3-2-1': 'A', '4-4-1-1': 'A', '4-5-1': 'A', '4-4-2': 'B',
    '4-2-2-2': 'B', '4-1-3-2': 'B', '4-3-1-2': 'B', '4-3-3': 'C', '3-4-3': 'D', '3-2-4-1': 'D',
    '3-3-3-1': 'D', '3-3-1-3': 'D', '3-4-2-1': 'D', '3-4-1-2': 'D', '3-1-4-2': 'D', '3-5-2': 'E',
    '3-5-1-1': 'E', '5-3-2': 'E', '5-4-1': 'E',
}

# Leagues whose teams are published, and those that may sign players.
TOP_LEAGUES = ["la_liga", "premier_league", "bundesliga", "serie_a", "ligue_1",
               "la_liga_hypermotion", "championship", "eredivise", "liga_portugal"]
FIT_LEAGUES = ["la_liga", "premier_league", "serie_a", "ligue_1", "bundesliga",
               "eredivise", "liga_portugal", "super_lig", "championship"]
LEAGUE_NAMES = {
    "la_liga": "La Liga", "premier_league": "Premier League", "bundesliga": "Bundesliga",
    "serie_a": "Serie A", "ligue_1": "Ligue 1", "la_liga_hypermotion": "La Liga Hypermotion",
    "championship": "EFL Championship", "eredivise": "Eredivise",
    "liga_portugal": "Liga Portugal", "champions_league": "Champions League",
    "conference_league": "Conference League", "europa_league": "Europa League",
    "copa_del_rey": "Copa del Rey",
}

# Player counter and the source fields it is the maximum of.
PLAYER_SOURCES = {
    "Passes": ["totalPassSS", "totalPassSW"],
    "AccuratePasses": ["accuratePassSS", "accuratePassSW"],
    "LongBalls": ["totalLongBallsSS"],
    "AccurateLongBalls": ["accurateLongBallsSS"],
    "OwnHalfPasses": ["totalOwnHalfPassesSS"],
    "AccurateOwnHalfPasses": ["accurateOwnHalfPassesSS"],
    "OppositionHalfPasses": ["totalOppositionHalfPassesSS"],
    "AccurateOppositionHalfPasses": ["accurateOppositionHalfPassesSS"],
    "Touches": ["touchesSS"],
    "PossessionLost": ["possessionLostCtrlSS"],
    "UnsuccessfulTouches": ["unsuccessfulTouchSS"],
    "Goals": ["goalsSS", "goalsSW"],
    "GoalAssists": ["goalAssistSS", "goalAssistSW"],
    "BigChancesCreated": ["bigChanceCreatedSS"],
    "BigChancesMissed": ["bigChanceMissedSS"],
    "KeyPasses": ["keyPassSS"],
    "TotalShots": ["totalShotsSS", "totalScoringAttSW"],
    "ShotsOnTarget": ["onTargetScoringAttemptSS", "ontargetScoringAttSW"],
    "ShotsOffTarget": ["shotOffTargetSS", "shotOffTargetSW"],
    "BlockedShots": ["blockedScoringAttemptSS", "blockedScoringAttSW"],
    "HitWoodwork": ["hitWoodworkSS"],
    "ExpectedGoals": ["expectedGoalsSS"],
    "ExpectedGoalsOnTarget": ["expectedGoalsOnTargetSS"],
    "ExpectedAssists": ["expectedAssistsSS"],
    "ShotValue": ["shotValueNormalizedSS"],
    "Crosses": ["totalCrossSS"],
    "AccurateCrosses": ["accurateCrossSS"],
    "AerialWon": ["aerialWonSS"],
    "AerialLost": ["aerialLostSS"],
    "DuelsWon": ["duelWonSS"],
    "DuelsLost": ["duelLostSS"],
    "Contests": ["totalContestSS"],
    "ContestsWon": ["wonContestSS"],
    "ChallengesLost": ["challengeLostSS"],
    "Dispossessed": ["dispossessedSS"],
    "Interceptions": ["interceptionWonSS"],
    "Clearances": ["totalClearanceSS", "totalClearanceSW"],
    "OutfielderBlocks": ["outfielderBlockSS"],
    "BallRecoveries": ["ballRecoverySS"],
    "Tackles": ["totalTackleSS", "totalTackleSW"],
    "TacklesWon": ["wonTackleSS", "wonTackleSW"],
    "LastManTackles": ["lastManTackleSS"],
    "ClearanceOffLine": ["clearanceOffLineSS"],
    "Fouls": ["foulsSS", "foulsSW"],
    "WasFouled": ["wasFouledSS", "wasFouledSW"],
    "Offsides": ["totalOffsideSS", "totalOffsideSW"],
    "YellowCards": ["yellowCardSW"],
    "RedCards": ["redCardSW"],
    "SecondYellowRedCards": ["secondYellowSW"],
    "RescindedRedCards": ["rescindedRedCardSW"],
    "PenaltyWon": ["penaltyWonSS", "penaltyWonSW"],
    "PenaltyMissed": ["penaltyMissSS"],
    "PenaltyFaced": ["penaltyFacedSS", "penaltyFacedSW"],
    "PenaltyConceded": ["penaltyConcededSS", "penaltyConcededSW"],
    "PenaltySaves": ["penaltySaveSS", "penaltySaveSW"],
    "PenaltyGoalsConceded": ["penGoalsConcededSW"],
    "OwnGoals": ["ownGoalsSS", "ownGoalsSW"],
    "ErrorsLeadToShot": ["errorLeadToAShotSS"],
    "ErrorsLeadToGoal": ["errorLeadToAGoalSS"],
    "MinutesPlayed": ["minutesPlayedSS", "minsPlayedSW"],
    "Rating": ["ratingSS"],
    "Saves": ["savesSS", "savesSW"],
    "SavedShotsInsideBox": ["savedShotsFromInsideTheBoxSS"],
    "Punches": ["punchesSS"],
    "HighClaims": ["goodHighClaimSS"],
    "CrossesNotClaimed": ["crossNotClaimedSS"],
    "GoalKicks": ["goalKicksSW"],
    "KeeperSweeperActions": ["totalKeeperSweeperSS"],
    "AccurateKeeperSweeperActions": ["accurateKeeperSweeperSS"],
    "GoalsConceded": ["goalsConcededSW"],
    "GoalsPrevented": ["goalsPreventedSS"],
    "CleanSheets": ["cleanSheetSW"],
    "KeeperSaveValue": ["keeperSaveValueSS"],
    "PassValue": ["passValueNormalizedSS"],
    "DribbleValue": ["dribbleValueNormalizedSS"],
    "DefensiveValue": ["defensiveValueNormalizedSS"],
    "GoalkeeperValue": ["goalkeeperValueNormalizedSS"],
    "TotalBallCarriesDistance": ["totalBallCarriesDistanceSS"],
    "BallCarriesCount": ["ballCarriesCountSS"],
    "TotalProgression": ["totalProgressionSS"],
    "BestBallCarryProgression": ["bestBallCarryProgressionSS"],
    "TotalProgressiveBallCarriesDistance": ["totalProgressiveBallCarriesDistanceSS"],
    "ProgressiveBallCarriesCount": ["progressiveBallCarriesCountSS"],
    "TopSpeed": ["topSpeedSS"],
    "KilometersCovered": ["kilometersCoveredSS"],
    "NumberOfSprints": ["numberOfSprintsSS"],
    "MetersCoveredWalkingKm": ["metersCoveredWalkingKmSS"],
    "MetersCoveredJoggingKm": ["metersCoveredJoggingKmSS"],
    "MetersCoveredRunningKm": ["metersCoveredRunningKmSS"],
    "MetersCoveredHighSpeedRunningKm": ["metersCoveredHighSpeedRunningKmSS"],
    "MetersCoveredSprintingKm": ["metersCoveredSprintingKmSS"],
    "CornersWon": ["wonCornersSW"],
    "CornersLost": ["lostCornersSW"],
    "CornersTaken": ["cornerTakenSW"],
}

# Lineup statistics that are not counters.
LINEUP_DENY = ["formationPlace", "formationUsed", "gameStarted", "totalSubOn", "totalSubOff"]

# Team statistic keys of the provider; the column is the key with
# a capital first letter.
TEAM_STAT_KEYS = [
    'ballPossession', 'bigChanceCreated', 'totalShotsOnGoal', 'goalkeeperSaves', 'cornerKicks',
    'fouls', 'passes', 'totalTackle', 'freeKicks', 'yellowCards', 'shotsOnGoal', 'hitWoodwork',
    'shotsOffGoal', 'blockedScoringAttempt', 'totalShotsInsideBox', 'totalShotsOutsideBox',
    'bigChanceScored', 'bigChanceMissed', 'accurateThroughBall', 'fouledFinalThird', 'offsides',
    'accuratePasses', 'throwIns', 'finalThirdEntries', 'accurateLongBalls', 'accurateCross',
    'duelWonPercent', 'dispossessed', 'groundDuelsPercentage', 'aerialDuelsPercentage',
    'dribblesPercentage', 'wonTacklePercent', 'interceptionWon', 'totalClearance', 'goalKicks',
    'redCards', 'expectedGoals', 'goalsPrevented', 'ballRecovery', 'touchesInOppBox',
    'finalThirdPhaseStatistic', 'errorsLeadToGoal', 'diveSaves', 'highClaims', 'punches',
    'errorsLeadToShot', 'penaltySaves', 'kilometersCovered', 'numberOfSprints',
]

# Player counters that are not kept after unification.
DROPPED_COUNTERS = [
    'ShotValue', 'SecondYellowRedCards', 'RescindedRedCards', 'Rating', 'KeeperSaveValue',
    'PassValue', 'DribbleValue', 'DefensiveValue', 'GoalkeeperValue', 'TotalBallCarriesDistance',
    'BallCarriesCount', 'TotalProgression', 'BestBallCarryProgression',
    'TotalProgressiveBallCarriesDistance', 'ProgressiveBallCarriesCount', 'TopSpeed',
    'KilometersCovered', 'NumberOfSprints', 'MetersCoveredWalkingKm', 'MetersCoveredJoggingKm',
    'MetersCoveredRunningKm', 'MetersCoveredHighSpeedRunningKm', 'MetersCoveredSprintingKm',
]

# Counters shown with zeros in player documents.
COUNTED_STATS = [
    'MinutesPlayed', 'Matches', 'Touches', 'Passes', 'AccuratePasses', 'KeyPasses', 'GoalAssists',
    'ExpectedAssists', 'BigChancesCreated', 'Crosses', 'AccurateCrosses', 'TotalShots',
    'ShotsOnTarget', 'Goals', 'ExpectedGoals', 'DuelsWon', 'AerialWon', 'Contests', 'ContestsWon',
    'Tackles', 'TacklesWon', 'Interceptions', 'Clearances', 'OutfielderBlocks', 'BallRecoveries',
    'Fouls', 'WasFouled', 'YellowCards', 'RedCards', 'Saves', 'GoalsConceded', 'CleanSheets',
]

# Metrics where less is better.
NEGATIVE_PLAYER_METRICS = [
    'PossessionLostPer90', 'PossessionLossRate', 'UnsuccessfulTouchRate', 'AerialLostPer90',
    'DispossessedPer90', 'DispossessedRate', 'GoalsConcededPer90', 'CrossesNotClaimedRate',
    'PenaltyGoalConcededRate', 'ErrorsLeadToShotRate', 'ErrorsLeadToGoalRate', 'FoulsPer90',
    'CardsPerFoul', 'YellowCardsPer90', 'PenaltyConcededRate', 'BigChancesMissedPer90',
    'BigChanceMissRate', 'HitWoodworkRate', 'OffsideRate',
]
NEGATIVE_TEAM_METRICS = ["PossessionLossRate", "ChallengesLostRate", "GoalsConcededPer90"]

# Metrics compared between a player and a team style.
STYLE_METRICS = [
    'TouchesPer90', 'PassesPer90', 'AccuratePassesPer90', 'PassAccuracy',
    'OppositionHalfPassesPer90', 'AccurateOppositionHalfPassesPer90', 'OppositionHalfPassAccuracy',
    'LongBallsPer90', 'AccurateLongBallsPer90', 'LongBallAccuracy', 'ProgressiveFieldTilt',
    'PossessionLostPer90', 'DispossessedPer90', 'UnsuccessfulTouchesPer90', 'KeyPassesPer90',
    'ExpectedAssistsPer90', 'GoalAssistsPer90', 'BigChancesCreatedPer90', 'CrossesPer90',
    'AccurateCrossesPer90', 'CrossAccuracy', 'ContestsPer90', 'ContestsWonPer90', 'ContestWinRate',
    'TotalShotsPer90', 'ShotsOnTargetPer90', 'ShotAccuracy', 'ExpectedGoalsPer90',
    'ExpectedGoalsPerShot', 'GoalsPer90', 'GoalConversion', 'BigChancesMissedPer90',
    'OffsidesPer90', 'TacklesPer90', 'TacklesWonPer90', 'TackleAccuracy', 'InterceptionsPer90',
    'ClearancesPer90', 'OutfielderBlocksPer90', 'BallRecoveriesPer90', 'DefensiveActionsPer90',
    'DuelsWonPer90', 'DuelWinRate', 'AerialWonPer90', 'AerialWinRate', 'ErrorsLeadToShotPer90',
    'FoulsPer90', 'WasFouledPer90', 'YellowCardsPer90', 'SavesPer90', 'SaveRate',
    'GoalsConcededPer90', 'GoalsPreventedPer90', 'HighClaimsPer90', 'CrossesNotClaimedPer90',
    'KeeperSweeperActionsPer90', 'KeeperSweeperAccuracy', 'PenaltySavesPer90', 'PenaltySaveRate',
    'CleanSheets',
]

# Cluster number and role name per position.
ROLE_NAMES = {
    "GK": ["Distributor", "Line Keeper", "Direct Outlet"],
    "CB": ["Circulator", "Deep Anchor", "Fragile Defender", "Duel Specialist",
           "Complete Builder", "Progressive Playmaker"],
    "FB": ["Balanced", "Runner", "Defensive"],
    "DM": ["Ball Winner", "Deep Playmaker", "Anchor"],
    "AM": ["Creator", "Scorer", "Hybrid"],
    "WG": ["Explosive", "Finisher", "Support"],
    "ST": ["Linker", "Poacher", "Target"],
}


def player_sources():
    """Counter name and its list of source columns, in catalogue order."""
    return dict(PLAYER_SOURCES)


def team_stat_columns():
    """Provider key and column name of the team statistics."""
    return {k: k[0].upper() + k[1:] for k in TEAM_STAT_KEYS}
