"""A dispatch of 60 orders to 12 couriers over seven zones, and the km of each leg."""

# courier, base zone, total km, stops (order, zone, km)
ROUTES = [
    (1, "zona_10", 0.0, [
        (147, "zona_10", 0.0), (377, "zona_10", 0.0), (379, "zona_10", 0.0), (395, "zona_10", 0.0), (484, "zona_10", 0.0),
    ]),
    (2, "zona_9", 0.0, [
        (195, "zona_9", 0.0), (242, "zona_9", 0.0), (412, "zona_9", 0.0), (740, "zona_9", 0.0), (780, "zona_9", 0.0),
    ]),
    (3, "zona_4", 0.0, [
        (158, "zona_4", 0.0), (222, "zona_4", 0.0), (289, "zona_4", 0.0), (588, "zona_4", 0.0), (671, "zona_4", 0.0),
    ]),
    (4, "zona_10", 1.19, [
        (641, "zona_10", 0.0), (704, "zona_10", 0.0), (821, "zona_10", 0.0), (793, "zona_9", 1.19), (818, "zona_9", 0.0),
    ]),
    (5, "zona_13", 0.0, [
        (18, "zona_13", 0.0), (19, "zona_13", 0.0), (153, "zona_13", 0.0), (154, "zona_13", 0.0), (211, "zona_13", 0.0),
    ]),
    (6, "zona_1", 0.0, [
        (4, "zona_1", 0.0), (28, "zona_1", 0.0), (54, "zona_1", 0.0), (65, "zona_1", 0.0), (134, "zona_1", 0.0),
    ]),
    (7, "zona_10", 2.91, [
        (86, "zona_11", 2.91), (152, "zona_11", 0.0), (264, "zona_11", 0.0), (352, "zona_11", 0.0), (354, "zona_11", 0.0),
    ]),
    (8, "zona_11", 0.0, [
        (378, "zona_11", 0.0), (424, "zona_11", 0.0), (561, "zona_11", 0.0), (564, "zona_11", 0.0), (575, "zona_11", 0.0),
    ]),
    (9, "zona_9", 4.35, [
        (655, "zona_11", 1.74), (804, "zona_11", 0.0), (676, "zona_4", 2.61), (755, "zona_4", 0.0), (837, "zona_4", 0.0),
    ]),
    (10, "zona_13", 0.0, [
        (342, "zona_13", 0.0), (400, "zona_13", 0.0), (782, "zona_13", 0.0), (841, "zona_13", 0.0), (881, "zona_13", 0.0),
    ]),
    (11, "zona_10", 29.63, [
        (187, "zona_1", 4.64), (223, "zona_1", 0.0), (416, "zona_1", 0.0), (809, "zona_1", 0.0), (9, "antigua", 24.99),
    ]),
    (12, "zona_4", 23.56, [
        (16, "antigua", 23.56), (155, "antigua", 0.0), (489, "antigua", 0.0), (811, "antigua", 0.0), (816, "antigua", 0.0),
    ]),
]
