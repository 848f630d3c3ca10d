"""Settings from the environment, with the defaults of the daemon they come from."""

from __future__ import annotations

import logging
import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from logging.handlers import TimedRotatingFileHandler

from .schema import BATCH_SIZE, DEFAULT_SLOT

log = logging.getLogger(__name__)
PREFIX = "WAL_WRITER_"
#: Fixed value: how long a send may take.
SEND_TIMEOUT_MS = 30_000
_INTEGER = re.compile(r"\+?[0-9]+")


def parse_unsigned(text: str | None, default: int, bits: int, name: str = "") -> int:
    """An unsigned number of so many bits, or the default with a warning. Blanks and signs but ``+`` are invalid."""
    if text is None:
        return default
    if _INTEGER.fullmatch(text) and int(text) < 1 << bits:
        return int(text)
    log.warning("%s%s=%r is no %d-bit number; using %d", PREFIX, name, text, bits, default)
    return default


@dataclass(frozen=True)
class PostgresConfig:
    host: str = "localhost"
    port: int = 5432
    user: str = "postgres"
    password: str = field(default="", repr=False)
    database: str = "postgres"
    slot: str = DEFAULT_SLOT

    def connection_string(self) -> str:
        """Key-value form; it holds the password, so it is never logged."""
        return f"host={self.host} port={self.port} user={self.user} password={self.password} dbname={self.database}"

    def jdbc(self) -> dict[str, str]:
        """Options of Spark's ``jdbc`` source."""
        return {
            "url": f"jdbc:postgresql://{self.host}:{self.port}/{self.database}",
            "user": self.user,
            "password": self.password,
            "driver": "org.postgresql.Driver",
        }


@dataclass(frozen=True)
class KafkaConfig:
    brokers: str = "localhost:9092"
    topic_prefix: str = "cdc"
    acks: str = "all"
    linger_ms: int = 5
    batch_size: int = 16384
    compression: str | None = None

    def options(self) -> dict[str, str]:
        """Options of Spark's ``kafka`` sink."""
        out = {
            "kafka.bootstrap.servers": self.brokers,
            "kafka.acks": self.acks,
            "kafka.linger.ms": str(self.linger_ms),
            "kafka.batch.size": str(self.batch_size),
            "kafka.request.timeout.ms": str(SEND_TIMEOUT_MS),
        }
        return out | ({"kafka.compression.type": self.compression} if self.compression else {})


    def producer(self) -> dict[str, str]:
        """Options of the producer sink: the same settings under the names of its client library."""
        out = {
            "kafka.bootstrap.servers": self.brokers,
            "kafka.acks": self.acks,
            "kafka.linger.ms": str(self.linger_ms),
            "kafka.batch.size": str(self.batch_size),
            "kafka.api.version.request": "true",
            "kafka.socket.timeout.ms": str(SEND_TIMEOUT_MS),
        }
        return out | ({"kafka.compression.type": self.compression} if self.compression else {})


@dataclass(frozen=True)
class ReplicationConfig:
    batch_size: int = BATCH_SIZE
    poll_interval_ms: int = 10
    wal_position: str | None = None


@dataclass(frozen=True)
class LoggingConfig:
    log_dir: str = "/var/log/wal-writer"
    level: str = "info"

    def start(self, logger: logging.Logger | None = None) -> logging.Logger:
        """Log to a file that is begun anew every day, and to the standard error stream, from ``level`` on."""
        logger = logger or logging.getLogger("tidelog")
        os.makedirs(self.log_dir, exist_ok=True)
        form = logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s")
        for handler in (TimedRotatingFileHandler(os.path.join(self.log_dir, "wal-writer.log"), when="midnight", utc=True, delay=True), logging.StreamHandler()):
            handler.setFormatter(form)
            logger.addHandler(handler)
        logger.setLevel({"trace": "DEBUG", "warn": "WARNING"}.get(self.level.lower(), self.level.upper()))
        return logger


@dataclass(frozen=True)
class StateConfig:
    state_dir: str | None = None
    persist_interval_secs: int = 60


@dataclass(frozen=True)
class AppConfig:
    postgres: PostgresConfig = PostgresConfig()
    kafka: KafkaConfig = KafkaConfig()
    replication: ReplicationConfig = ReplicationConfig()
    logging: LoggingConfig = LoggingConfig()
    state: StateConfig = StateConfig()

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> AppConfig:
        """Read ``WAL_WRITER_*``; invalid numbers fall back to their defaults with a warning."""
        env = os.environ if env is None else env
        text = lambda name, default=None: env.get(PREFIX + name, default)
        number = lambda name, default, bits: parse_unsigned(text(name), default, bits, name)
        pg, kafka, rep, logs, state = PostgresConfig(), KafkaConfig(), ReplicationConfig(), LoggingConfig(), StateConfig()
        return cls(
            PostgresConfig(
                text("PG_HOST", pg.host), number("PG_PORT", pg.port, 16), text("PG_USER", pg.user),
                text("PG_PASSWORD", pg.password), text("PG_DATABASE", pg.database), text("PG_SLOT_NAME", pg.slot),
            ),
            KafkaConfig(
                text("KAFKA_BROKERS", kafka.brokers), text("KAFKA_TOPIC_PREFIX", kafka.topic_prefix), text("KAFKA_ACKS", kafka.acks),
                number("KAFKA_LINGER_MS", kafka.linger_ms, 32), number("KAFKA_BATCH_SIZE", kafka.batch_size, 32), text("KAFKA_COMPRESSION"),
            ),
            ReplicationConfig(number("REPLICATION_BATCH_SIZE", rep.batch_size, 32), number("REPLICATION_POLL_INTERVAL_MS", rep.poll_interval_ms, 64), text("REPLICATION_WAL_POSITION")),
            LoggingConfig(text("LOG_DIR", logs.log_dir), text("LOG_LEVEL", logs.level)),
            StateConfig(text("STATE_DIR"), number("STATE_PERSIST_INTERVAL_SECS", state.persist_interval_secs, 64)),
        )
