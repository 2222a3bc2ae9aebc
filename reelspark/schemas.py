"""Explicit schemas of the engine's tables."""

FRAMES = "match_id string, segment string, ptstime decimal(18,6), ts_frame int, frame_number bigint, segment_number int"
MESSAGE = "matchId string, streamUrl string, streamStatus string, league string, lang string, game struct<id:string,name:string>, tournament struct<id:string,name:string>"
DETECTIONS = "match_id string, frame_number bigint, model string, boxes array<array<float>>, confidences array<float>, classes array<float>"
CUTS = "match_id string, frame_number bigint"
REQUEST = "analyzer_type string, streamUrl string, matchId string, params map<string,string>"
PROBE = "frames array<struct<pkt_pts_time:string>>"
STREAMS = "streams array<struct<width:int,height:int,r_frame_rate:string>>"
