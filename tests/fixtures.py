"""Small payment logs, written from (kind, time, card, trace number, code, channel) rows."""

LONG = "<" + "=" * 73 + ">"
NINE = "<" + "=" * 9 + ">"


def block(kind, time, pan, stan, code=None, channel=None, gap="\n\n"):
    request = kind == "Q"
    lines = [
        f"Pid: 22664 {'Received' if request else 'Sent'} At: {time}",
        f"MessageId: {'1200' if request else '1210'}",
        f"Field 002: {pan}",
        f"Field 011: {stan}",
    ]
    if code is not None:
        lines.append(f"Field 039: {code}")
    if channel is not None:
        lines.append(f"Field 123: {channel}")
    return gap.join(lines) + gap


def log(rows, separator, day, blank_after_request=False, title=None):
    text = ""
    for kind, time, *rest in rows:
        text += (title or "") + block(kind, f"{day} {time}", *rest) + separator + "\n"
        if blank_after_request and kind == "Q":
            text += "\n\n" + separator + "\n\n"
    return text


# Three pairs with a blank block after each request.
SAMPLE = [
    ("Q", "12:02:26.721", "9229814714205000026", "661765234767", None, "UPI"),
    ("P", "12:02:26.907", "9229814714205000026", "661765234767", "000", "UPI"),
    ("Q", "12:02:27.100", "9229814714205000027", "661765234768", None, "CARD"),
    ("P", "12:02:27.542", "9229814714205000027", "661765234768", "000", "CARD"),
    ("Q", "12:02:28.234", "9229814714205000028", "661765234769", None, "WALLET"),
    ("P", "12:02:28.689", "9229814714205000028", "661765234769", "001", "WALLET"),
]

# The nine corner cases. Responses carry no channel.
CORNERS = [
    ("Q", "18:00:00.000", "1234567890123456", "111111", None, "UPI"),
    ("P", "18:00:00.100", "1234567890123456", "111111", "000"),
    ("P", "18:00:01.050", "1234567890123457", "222222", "000"),
    ("Q", "18:00:01.000", "1234567890123457", "222222", None, "CARD"),
    ("Q", "18:00:02.000", "9999999999999999", "333333", None, "WALLET"),
    ("Q", "18:00:02.500", "8888888888888888", "333333", None, "WALLET"),
    ("P", "18:00:02.150", "9999999999999999", "333333", "000"),
    ("P", "18:00:02.650", "8888888888888888", "333333", "001"),
    ("P", "18:00:03.000", "7777777777777777", "444444", "000"),
    ("Q", "18:00:04.000", "6666666666666666", "555555", None, "UPI"),
    ("Q", "18:00:05.000", "5555555555555555", "666666", None, "CARD"),
    ("P", "18:00:05.200", "5555555555555555", "666666", "000"),
    ("Q", "18:00:06.000", "4444444444444444", "777777", None, "WALLET"),
    ("P", "18:00:06.500", "4444444444444444", "777777", "005"),
    ("Q", "18:00:07.000", "3333333333333333", "888888", None, "UPI"),
    ("P", "18:00:07.000", "3333333333333333", "888888", "000"),
    ("Q", "18:00:08.000", "2222222222222222", "999999", None, "CARD"),
    ("P", "18:00:13.500", "2222222222222222", "999999", "000"),
]

# Ten pairs as (second, latency, code, channel); requests have an empty code.
TEN = [
    (26, 145, "000", "UPI"),
    (27, 350, "000", "CARD"),
    (28, 105, "000", "NET_BANKING"),
    (29, 89, "000", "MOBILE_WALLET"),
    (30, 578, "000", "UPI"),
    (31, 823, "003", "CARD"),
    (32, 245, "000", "NET_BANKING"),
    (33, 467, "000", "MOBILE_WALLET"),
    (34, 734, "000", "UPI"),
    (35, 412, "000", "CARD"),
]


def sample_log():
    return log(SAMPLE, LONG, "08/09/2026", blank_after_request=True)


def corner_log():
    return "CORNER CASES\n=====\n" + log(CORNERS, LONG, "09/26/2026", title="\nTEST CASE\n─────\n\n")


def ten_log():
    rows = []
    for second, latency, code, channel in TEN:
        pan, stan = f"40000000000000{second}", f"6617652347{second}"
        rows.append(("Q", f"12:02:{second}.100", pan, stan, "", channel))
        end = second * 1000 + 100 + latency
        rows.append(("P", f"12:02:{end // 1000}.{end % 1000:03d}", pan, stan, code, channel))
    return log(rows, NINE, "08/09/2026")
