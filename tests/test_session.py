"""Session helpers: checkpoint folder rule and SQL options."""

from accounthealth import session


def test_checkpoint_dir_is_kept_when_configured(spark, tmp_path):
    current = session.checkpoint_dir(spark)
    assert current                                   # set for the test session
    assert session.ensure_checkpoint_dir(spark) == current
    assert spark.sparkContext.getCheckpointDir()


def test_configure_sets_adaptive_execution(spark):
    session.configure(spark)
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_column_builders_are_reused_within_a_session(spark):
    from accounthealth.operators import explorer, marts, workspace

    assert workspace.attention_reasons() is workspace.attention_reasons()
    assert marts.health_score_expr() is marts.health_score_expr()
    assert explorer.brief_text() is explorer.brief_text()
