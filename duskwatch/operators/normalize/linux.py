"""Syslog auth lines: sshd logins and sudo. The stamp has no year, so it is a job parameter."""

from pyspark.sql import functions as F

from duskwatch.operators.normalize.base import Normalizer, groups, pack, unpack

# Syslog prefix and the message shapes of sshd and sudo.
PREFIX = r"(\w{3})\s+(\d{1,2})\s+(\d{2}:\d{2}:\d{2})\s+(\S+)\s+(\S+?):\s+(.*?)[\s\x1c-\x1f]*$"
FAILED = r".*?Failed password for (?:invalid user )?(\S+) from (\S+) port (\d+).*$"
ACCEPTED = r".*?Accepted (?:password|publickey) for (\S+) from (\S+) port (\d+).*$"
SUDO = r".*?(\S+)\s*:\s*TTY=\S+\s*;\s*PWD=\S+\s*;\s*USER=(\S+)\s*;\s*COMMAND=(.*)$"


def _details(c):
    """[kind, three captures]; a failed login is looked for before an accepted one."""
    process, message = c[4], c[5]
    tagged = lambda kind, g: F.when(g.isNotNull(), F.concat(F.array(F.lit(kind)), g))
    return (
        F.when(process.startswith("sshd"),
               F.coalesce(
                   # the cheap substring test spares most lines the regex
                   F.when(message.contains("Failed password for "), tagged("failed", groups(message, FAILED, 3))),
                   F.when(message.contains("Accepted "), tagged("accepted", groups(message, ACCEPTED, 3)))))
        .when(process.startswith("sudo"), tagged("sudo", groups(message, SUDO, 3)))
    )


def _fields(c, d, year):
    kind, user = d[0], d[1]
    sudo = kind == "sudo"
    # A two-space padded day never reaches the parser: month, day and time are joined anew.
    stamp = F.concat_ws(" ", F.lit(str(year)), c[0], c[1], c[2])
    return {
        "event_time": F.when(c.isNotNull(), F.try_to_timestamp(stamp, F.lit("yyyy MMM d H:m:s"))),
        "event_type": (F.when(kind == "failed", F.lit("login_failure"))
                       .when(kind == "accepted", F.lit("login_success"))
                       .when(sudo, F.lit("privilege_escalation"))),
        "severity": (F.when(kind == "failed", F.lit("medium"))
                     .when(kind == "accepted", F.lit("low"))
                     .when(sudo & (d[2] == "root"), F.lit("high"))
                     .when(sudo, F.lit("medium"))),
        "host": c[3],
        "username": user,
        "src_ip": F.when(~sudo, d[2]),
        "additional_data": (
            F.when(kind == "failed", F.create_map(F.lit("port"), d[3], F.lit("auth_method"), F.lit("password")))
            .when(kind == "accepted", F.create_map(F.lit("port"), d[3]))
            .when(sudo, F.create_map(F.lit("target_user"), d[2], F.lit("command"), d[3]))),
    }


NORMALIZER = Normalizer("linux_ssh", lambda line: pack(line, PREFIX, 6),
                        lambda packed: unpack(packed, 6), _fields, _details)
