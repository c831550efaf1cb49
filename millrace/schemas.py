"""Schemas of the feeds."""

SENSOR = "id string, ts long, vc int"
BEHAVIOUR = "userId long, itemId long, categoryId int, behavior string, timestamp long"
AD_CLICK = "userId long, adId long, province string, city string, timestamp long"
LOGIN = "userId long, ip string, eventType string, eventTime long"
ORDER_EVENT = "orderId long, eventType string, txId string, eventTime long"
RECEIPT = "txId string, payChannel string, eventTime long"
MARKETING = "userId long, behavior string, channel string, timestamp long"
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
